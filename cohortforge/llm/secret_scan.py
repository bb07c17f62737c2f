"""Secret scanning: candidate strings, and a random forest that removes false findings.

A candidate is a run of 16 or more key characters with a digit in it, or the
value of an assignment to a name with a secret word in it, of 8 or more
characters up to a quote, white space or separator.  ``=`` ends a run but as
padding.  A random forest judges each one by its length and mix of characters, the
transitions between them, how much of it dictionary words cover, path and
separator marks, and the words around it.  The forest is fitted by Spark ML on
labelled findings and then laid out in literal arrays that an expression walks,
so that scanning is one pass of built-in functions over the texts: no shuffle, no Python.

Labelled findings: ``TRAIN_ROWS`` rows made from the templates below, each a
random spelling of a secret or of something that looks like one, between words
of prose, cut by the same expression as the texts.
"""

from __future__ import annotations

import json
import random
import string

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import frozen

TRAIN_ROWS = 4000
TREES, DEPTH = 15, 5
SURE = 0.5              # least share of the trees' votes
MARK = "[SECRET]"

SECRET_WORD = "token|secret|passw|pwd|api.?key|access.?key|auth|bearer|credential|private"
_ASSIGNED = r"[\"'`]?[\x20\t]{0,2}(?:=>|[=:])[\x20\t]{0,2}[\"'`]?"
_NAME = "(?i:token|secret|passw|passphrase|pwd|api[_-]?key|access[_-]?key|auth(?!or(?!iz))|credential|private)[A-Za-z0-9_-]{0,24}"
_VALUE = "[A-Za-z0-9+/_.~@#$%^&*!?-]"
# the value of an assignment to such a name; or a long run with a digit
CANDIDATE = (rf"(?<!{_VALUE})(?={_VALUE}{{8}})(?<=[=:>][\x20\t]{{0,2}}[\"'`]?)(?<={_NAME}{_ASSIGNED}){_VALUE}{{8,}}+={{0,2}}+"
             r"|(?<![A-Za-z0-9+/_.~-])(?=[A-Za-z+/_.~-]*+[0-9])[A-Za-z0-9+/_.~-]{16,}+(?:={1,2}+(?![A-Za-z0-9+/_.~-]))?")

# fixed: words that cover parts of harmless strings
DICTIONARY = (
    "about access after again also archive article asset auth back base begin between block blog body book branch build cache "
    "channel chapter check class client code color column comment common compile config content count create custom daily data "
    "date debug default demo description detail dev directory display docs document domain download draft edit element email end "
    "entry error event example export feature field figure file filter final first font for form format free from full function "
    "general get global google group guide head header height help history home host html http https icon image import index info "
    "input install inter item java javascript key label lang large last latest layout left length level lib library license line "
    "link list load local log login main manual map master media member menu message meta method min mobile model module month "
    "more name news next node note number object old online open option order other output package page panel parent part path "
    "photo picture play plugin point post preview previous print private process product profile project public query random "
    "read ready record release remove report request reset resource response result return review right root row run sample save "
    "schema script search section select send server service session set setting short show site size small source spec stage "
    "standard start state static status step store string style support system tab table tag target task team temp template test "
    "text the theme this thread thumb time title tool top total track type under unit update upload url user utils value version "
    "video view web week width wiki window with work www year your com net org").split()

# fixed: frequent letter pairs of European languages
PAIRS = ("th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve co me de hi ri ro ic ne ea ra "
         "ce li ch ll be ma si om ur ie ge un ei au sc ht qu ai eu la ci el").split()

FEATURES = ("size", "digits", "upper", "lower", "distinct", "changes", "pairs", "covered", "path", "joints", "hexadecimal", "known_start",
            "secret_word", "assigned", "quoted", "other_word", "repeats", "password_name", "marks")


def features(c: Column, before: Column, after: Column) -> list[Column]:
    """``FEATURES`` of a candidate between the text before and after it."""
    n = F.length(c)
    low, near = F.lower(c), F.lower(F.right(before, F.lit(32)))

    def count(pattern: str, of: Column = c) -> Column:
        return F.regexp_count(of, F.lit(pattern))

    def flag(condition: Column) -> Column:
        return F.when(condition, 1.0).otherwise(0.0)

    return [x.cast("double") for x in (
        n, count("[0-9]") / n, count("[A-Z]") / n, count("[a-z]") / n, F.size(F.array_distinct(F.split(c, ""))),
        count("(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])|(?<=[a-z])(?=[A-Z])") / n,
        count(f"(?={'|'.join(PAIRS)})", low) / n,
        1 - F.length(F.regexp_replace(low, "|".join(sorted(DICTIONARY, key=lambda w: (-len(w), w))), "")) / n,
        count("[/.]"), count("[-_]"), flag(c.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")),
        flag(c.rlike("^(?:AKIA|ASIA|gh[pousr]_|xox[abps]-|sk[-_]|pk_live|AIza|eyJ|glpat-|npm_)")),
        flag(near.rlike(SECRET_WORD)),
        flag(before.rlike("[=:]\\s*[\"'`]?$")), flag(before.rlike("[\"'`]$") & after.rlike("^[\"'`]")),
        flag(near.rlike("sha|md5|commit|checksum|digest|hash|uuid|guid|version|http|href|src|image|revision|isbn|order|phone|file|path")),
        flag(c.rlike("(.)\\1{5}")), flag(near.rlike(f"(?:passw|passphrase|pwd)[a-z0-9_-]*{_ASSIGNED}$")), count("[@#$%^&*!?]"))]


# ---------------------------------------------------------------- training

def _spellings(pick: random.Random) -> tuple[list, list]:
    """One (before, candidate, after) of every kind of secret, and of every kind of harmless string."""
    def of(alphabet: str, n: int) -> str:
        return "".join(pick.choice(alphabet) for _ in range(n))

    def made() -> str:          # a word of no dictionary
        return "".join(of("bcdfghklmnprstvwz", 1) + of("aeiou", 1) for _ in range(pick.randint(2, 3))) + pick.choice(["", "n", "r", "st"])

    hexadecimal, letters, base64 = "0123456789abcdef", string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/"
    word = lambda: pick.choice(DICTIONARY)
    either = lambda: pick.choice([word, made])()
    name = pick.choice(["token", "secret", "api_key", "API_KEY", "password", "TOKEN", "access_key", "auth_token", "client_secret", "Bearer", "credential"])
    phrase = pick.choice(["password", "PASSWORD", "DB_PASSWORD", "passwd", "db_pwd", "passphrase", "\"password\"", "user_password"])
    setting = pick.choice(["GITHUB_TOKEN", "AWS_ACCESS_KEY_ID", "API_TOKEN", "CLIENT_SECRET", "export AUTH_TOKEN"]) + "="
    sign = pick.choice([" = \"", "=", ": ", ": \"", " = '", "=\"", " := \""])
    end = pick.choice(["\"", "\"!!", "\" ", "\";", "'", "\n", "\",", "\"###", " "])
    stop = pick.choice([" ", "\n", ".", ","])
    prose = pick.choice(["and the end of ", "in der ", "le ", "x ", "see. ", "", "the following ", "| "])
    status = pick.choice(["required", "optional", "undefined", "disabled", "forgotten", "generated", "protected", "environment", "incorrect"])
    swapped = str.translate(either().capitalize() + either(), str.maketrans(dict(pick.sample([("o", "0"), ("a", "4"), ("e", "3"), ("i", "1"), ("s", "5")], 3))))
    named, worded = prose + name + sign, prose + phrase + sign
    h40, h32 = of(hexadecimal, 40), of(hexadecimal, 32)
    b64 = of(base64, 43) + "="
    secrets = [
        (worded, "-".join([either(), made(), *[either() for _ in range(pick.randint(1, 2))]]), end),
        (worded, "-".join(either() for _ in range(4)), end),
        (worded, swapped + pick.choice("&!#@$") + of(string.digits, pick.randint(1, 2)), end),
        (worded, made() + of(string.digits, pick.randint(1, 2)) + word(), end),
        (worded, word() + of(string.digits, 1) + word() + word(), end),
        (setting, "AKIA" + of(string.ascii_uppercase + string.digits, 16), "\n"), (setting, "ghp_" + of(letters, 36), "\n"), (setting, h40, "\n"),
        (named, h40, end), (named, h40.upper(), end), (named, h32, end), (named, b64, end), (named, of(letters, 24) + "4", end),
        (prose, "AKIA" + of(string.ascii_uppercase, 15) + "2", end), (prose, "ghp_" + of(letters, 36), end),
        (named, "sk-" + h40, end), (named, word() + "-" + of(letters, 18) + "9", end)]
    others = [
        (prose + phrase + pick.choice([": ", " = ", "="]), status, pick.choice([" ", "\n", ", "])),
        (named, ".".join([word(), word(), word()]), end), (worded, "_".join([word(), word(), word()]), end), (named, status, end),
        (prose + pick.choice(["commit ", "sha256:", "sha1 ", "md5: ", "checksum = ", "digest: ", "hash ", "revision "]), h40, stop),
        (prose + pick.choice(["uuid ", "id: ", "", "guid="]), "-".join([h32[:8], h32[8:12], h32[12:16], h32[16:20], h32[20:]]), stop),
        (prose, f"{word()}/{word()}/2024/{word()}.html", " "), (prose + "https:", f"//www.{word()}.com/{word()}/{of(string.digits, 6)}", " "),
        (prose, of(string.digits, 17), " "), (prose + pick.choice(["", "card ", "number: ", "order = "]), of(string.digits, 16), " "),
        (prose, f"{word()}_{word()}_{word()}_{of(string.digits, 2)}", " "), (named, f"{word()}_{word()}_{word()}_1", end),
        (named, "x" * 24 + "1", end), (named, "0" * 32, end), (prose + "<img src=\"data:image/png;base64,", of(base64, 88), "\""),
        (prose, f"2024-05-{of(string.digits, 2)}-{word()}-{word()}", " "), (prose, f"{word()}.{of(string.digits, 2)}-{word()}.{word()}.com", " ")]
    return secrets, others


def labelled_findings(spark: SparkSession, rows: int = TRAIN_ROWS, seed: int = 5) -> DataFrame:
    """(``before``, ``candidate``, ``after``, ``label``, ``kind``): made from templates, the same for the same seed.

    The rows are a literal of the plan; they are cut by the scan's own
    expression, so what the scan would not find is not learned.
    """
    pick, made = random.Random(seed), []
    while len(made) < rows:
        for label, some in zip((1.0, 0.0), _spellings(pick)):
            made += [{"text": b + c + a, "whole": c, "label": label, "kind": k} for k, (b, c, a) in enumerate(some)]
    table = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(made[:rows])), "array<struct<text:string,whole:string,label:double,kind:int>>")))
    cut = table.select("whole", "label", "kind", _cut(F.col("text")).alias("cut"))
    found = cut.select("label", "kind", "cut", "whole", F.posexplode("cut").alias("i", "candidate")).where("i % 2 = 1")
    hit = F.col("whole").contains(F.col("candidate")) | F.col("candidate").contains(F.col("whole"))
    return found.select(F.get("cut", F.col("i") - 1).alias("before"), "candidate", F.get("cut", F.col("i") + 1).alias("after"),
                        F.when(hit, F.col("label")).otherwise(0.0).alias("label"), "kind")


def train(spark: SparkSession, rows: int = TRAIN_ROWS, trees: int = TREES, depth: int = DEPTH) -> RandomForestClassificationModel:
    found = labelled_findings(spark, rows)
    values = features(F.col("candidate"), F.col("before"), F.col("after"))
    table = found.select(*[v.alias(n) for v, n in zip(values, FEATURES)], "label")
    table = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(frozen(table))
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=5, featureSubsetStrategy="sqrt").fit(table)


def votes(model: RandomForestClassificationModel, at: Column) -> Column:
    """The share of trees that call a candidate a secret, as an expression over an array of its features.

    Every tree is laid out as a full binary tree in literal arrays: node i's
    children are 2i + 1 and 2i + 2, and a leaf above the last level hands its
    answer down.  A walk takes as many steps as the deepest tree has levels.
    """
    trees = [tree._java_obj.rootNode() for tree in model.trees]
    depth = max(t.subtreeDepth() for t in trees)
    inner, leaves = (1 << depth) - 1, 1 << depth
    feature, threshold, answer = [0] * (inner * len(trees)), [0.0] * (inner * len(trees)), [0.0] * (leaves * len(trees))

    def lay(t: int, node, i: int, level: int) -> None:
        if level == depth:
            answer[t * leaves + i - inner] = float(node.prediction())
        elif node.subtreeDepth() == 0:
            lay(t, node, 2 * i + 1, level + 1)
            lay(t, node, 2 * i + 2, level + 1)
        else:
            feature[t * inner + i], threshold[t * inner + i] = node.split().featureIndex(), node.split().threshold()
            lay(t, node.leftChild(), 2 * i + 1, level + 1)
            lay(t, node.rightChild(), 2 * i + 2, level + 1)

    for t, root in enumerate(trees):
        lay(t, root, 0, 0)
    features_at, thresholds, answers = (F.expr(f"array({', '.join(x)})") for x in (
        map(str, feature), (f"{x!r}D" for x in threshold), (f"{x!r}D" for x in answer)))

    def walk(t: Column) -> Column:
        def step(i: Column, _level: Column) -> Column:
            here = t * inner + i
            return 2 * i + F.when(F.get(at, F.get(features_at, here)) <= F.get(thresholds, here), 1).otherwise(2)
        return F.aggregate(F.sequence(F.lit(1), F.lit(max(depth, 1))) if depth else F.array().cast("array<int>"), F.lit(0), step)

    return F.aggregate(F.sequence(F.lit(0), F.lit(len(trees) - 1)), F.lit(0.0),
                       lambda s, t: s + F.get(answers, t * leaves + walk(t) - inner)) / len(trees)


# ---------------------------------------------------------------- scanning

# The text is cut at candidates: U+0001 marks the cuts, after U+0001 and U+0002 themselves are spelled out.
def _spelled(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\u0002"), F.lit("\u0002(")), F.lit("\u0001"), F.lit("\u0002)"))


def _plain(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\u0002)"), F.lit("\u0001")), F.lit("\u0002("), F.lit("\u0002"))


def _cut(text: Column) -> Column:
    return F.split(F.regexp_replace(_spelled(text), CANDIDATE, "\u0001$0\u0001"), "\u0001")


def scan(docs: DataFrame, model: RandomForestClassificationModel, text_col: str = "text", sure: float = SURE) -> DataFrame:
    """``docs`` with ``_parts``: the text in pieces, each with ``vote`` (null: not a candidate) and ``text``."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    cut = docs.withColumn("_cut", _cut(text))
    cut = cut.withColumn("_parts", F.transform("_cut", lambda p, i: F.struct(
        p.alias("text"),
        F.when(i % 2 == 1, F.array(*features(p, F.get("_cut", i - 1), F.get("_cut", i + 1)))).alias("f"))))
    return cut.withColumn("_parts", F.transform("_parts", lambda p: F.struct(
        p["text"].alias("text"), F.when(p["f"].isNotNull(), votes(model, p["f"])).alias("vote")))).drop("_cut")


def findings(docs: DataFrame, model: RandomForestClassificationModel | None = None, id_col: str = "doc_id", text_col: str = "text",
             sure: float = SURE) -> DataFrame:
    """One row per input row: id, ``n_candidates``, ``secrets``.

    ``secrets``: start and end (code points, end exclusive) and vote of each
    candidate with at least the share ``sure`` of the votes, in text order.  A
    null or empty text has none.  Rows that repeat get equal results.  Other
    columns are not read.  An empty table gives an empty result.
    """
    model = model or train(docs.sparkSession)
    parts = scan(docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text")), model, "_text", sure)
    start = F.from_json(F.lit('{"at": 0, "found": []}'), "at bigint, found array<struct<start:bigint,end:bigint,vote:double>>")

    def add(state: Column, p: Column) -> Column:
        end = state["at"] + F.length(_plain(p["text"]))
        hit = F.array(F.struct(state["at"].alias("start"), end.alias("end"), p["vote"].alias("vote")))
        return F.struct(end.cast("bigint").alias("at"), F.when(p["vote"] >= sure, F.concat(state["found"], hit)).otherwise(state["found"]).alias("found"))

    return parts.select(F.col("_id").alias(id_col), ((F.size("_parts") - 1) / 2).cast("long").alias("n_candidates"),
                        F.aggregate("_parts", start, add, lambda s: s["found"]).alias("secrets"))


def redact(docs: DataFrame, model: RandomForestClassificationModel | None = None, text_col: str = "text", sure: float = SURE,
           mark: str = MARK) -> DataFrame:
    """``docs`` with every secret in the texts replaced by ``mark``; other texts and columns as they were, null texts too."""
    model = model or train(docs.sparkSession)
    column = F.col(f"`{text_col}`")
    parts = scan(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), column.alias("_text")), model, "_text", sure)
    clean = F.array_join(F.transform("_parts", lambda p: F.when(p["vote"] >= sure, F.lit(mark)).otherwise(_plain(p["text"]))), "")
    text = F.when(F.exists("_parts", lambda p: p["vote"] >= sure), clean).otherwise(F.col("_text"))
    return parts.select(*[text.alias(c) if c == text_col else F.col("_row").getField(c).alias(c) for c in docs.columns])
