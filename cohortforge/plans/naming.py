"""Column naming of a sequence of left merges (suffix-on-clash rule)."""

from __future__ import annotations

from collections.abc import Sequence


class MergeNames:
    """Tracks the left table's columns across a chain of merges.

    ``add(names, suffix)`` returns the final names of the right columns: a
    right name that already exists on the left gets ``suffix`` and the left
    keeps its own.  With ``suffix=None`` (a merge without suffixes) both
    sides of a clash are renamed with ``_x`` / ``_y``.
    """

    def __init__(self, left: Sequence[str]):
        self.cols: list[str] = list(left)
        self.renamed_left: dict[str, str] = {}

    def add(self, names: Sequence[str], suffix: str | None) -> list[str]:
        existing = set(self.cols)
        out = []
        for n in names:
            if n in existing:
                if suffix is None:
                    i = self.cols.index(n)
                    self.cols[i] = n + "_x"
                    self.renamed_left[n] = n + "_x"
                    out.append(n + "_y")
                else:
                    out.append(n + suffix)
            else:
                out.append(n)
        self.cols.extend(out)
        return out
