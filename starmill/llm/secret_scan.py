"""Secret scans: candidates by pattern, false positives removed by a random forest.

1. One pass of built-in string functions marks every candidate in the whole text and splits the text
   at the marks, so candidates and the text around them come from one pattern match. Candidates are
   runs of at least ``SHORTEST`` token characters with a digit or a provider's prefix. Positions are running sums of lengths
   within the document.
2. Each candidate gets features: length and alphabet, transitions between character classes, share of
   it that dictionary words cover, whether it stands in a path or address, and what its neighbouring
   words are.
3. A random forest (Spark ML, JVM) is trained on labelled findings and gives each candidate a
   probability. Findings below ``THRESHOLD`` are false positives. The training set may be bounded
   (``train_most`` findings by a hash); every candidate is scored.

Labelled findings have the columns of ``candidates`` and ``label`` (1 secret, 0 not). Where no such
table exists, ``weak_labels`` derives them from formats that providers publish, from keyed assignments,
and, as negatives, from check digits, addresses and plain prose.

Defined results: null and empty texts have no candidates. Null ids pass through. Repeated rows give
repeated findings. With one kind of label only, its value is every candidate's probability; with none,
the probability is 1, since nothing shows a candidate to be false. Empty tables give empty results.
Extra columns are ignored by ``scan`` and kept by ``redact``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.common import free_names, named
from starmill.llm.exact_dedup import located
from starmill.llm.quality_rules import STOP_WORDS
from starmill.session import stored

SHORTEST = 12
AROUND = 60
THRESHOLD = 0.5
TRAIN_MOST = 20_000
TREES, DEPTH, SEED = 24, 6, 11
MARK, OTHER = "\u0001", "\u0002"
REDACTED = "<secret>"

# Names that credentials are assigned to, and published formats of keys.
KEY_NAMES = (
    "password|passwd|passphrase|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|"
    "client[_-]?secret|auth|credential|bearer"
)
KEYED = rf"(?i)(?:{KEY_NAMES})\W{{0,4}}\s*(?:[:=]|=>)\s*[\"'`]?$"
PREFIXES = "AKIA|ASIA|gh[pousr]_|xox[abprs]-|sk_live_|AIza|glpat-|eyJ"
CANDIDATE = (
    rf"(?<![A-Za-z0-9+/_-])(?=(?:{PREFIXES})|[A-Za-z+/_-]*+[0-9])"
    rf"[A-Za-z0-9+/_-]{{{SHORTEST},}}+={{0,2}}"
)
PROVIDER = (
    r"^(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[0-9A-Za-z-]{10,}|"
    r"sk_live_[0-9A-Za-z]{16,}|AIza[0-9A-Za-z_-]{35}|glpat-[0-9A-Za-z_-]{20,}|"
    r"eyJ[A-Za-z0-9_-]{10,})$"
)
# Frequent syllables and words of prose, for the dictionary share.
DICTIONARY = tuple(dict.fromkeys([
    *[w for w in STOP_WORDS if len(w) >= 3],
    *"tion ing ment ness able ible ation sch lich keit heit ung ción mente ado eau elle pour que"
    " version license example test sample placeholder dummy changeme default".split(),
]))

FEATURES = (
    "length", "hex_share", "digit_share", "upper_share", "lower_share", "distinct_share",
    "transitions", "letter_runs", "dictionary_share", "only_digits", "luhn", "in_path", "in_address",
    "keyed", "assigned", "quoted", "key_word_near", "left_words", "right_words", "provider",
)


def parts(text: Column) -> Column:
    """The text split at its candidates: text and candidates in turn, beginning with text."""
    clean = F.translate(F.coalesce(text, F.lit("")), MARK, OTHER)
    marked = F.regexp_replace(clean, CANDIDATE, f"{MARK}$0{MARK}")
    return F.split(marked, MARK, -1)


def _located_parts(rows: DataFrame, doc_id: str, text: str, file: str, row: str) -> DataFrame:
    return rows.select(
        named(rows, doc_id).cast("long").alias("doc_id"),
        named(rows, file).alias("file"),
        named(rows, row).alias("row"),
        parts(named(rows, text)).alias("parts"),
    ).filter(F.size("parts") > 1)


def candidates(rows: DataFrame, doc_id: str, text: str, file: str, row: str) -> DataFrame:
    """One row per candidate of rows that carry their locator in ``file`` and ``row``."""
    found = _located_parts(rows, doc_id, text, file, row).selectExpr(
        "doc_id", "file", "row",
        "inline(transform(sequence(1, size(parts) - 2, 2), i -> named_struct("
        "'number', i, 'gap', length(parts[i - 1]), 'value', parts[i],"
        f" 'left', right(parts[i - 1], {AROUND}), 'right', left(parts[i + 1], {AROUND}))))",
    )
    before = Window.partitionBy("file", "row").orderBy("number").rowsBetween(
        Window.unboundedPreceding, -1
    )
    taken = F.sum(F.col("gap") + F.length("value")).over(before)
    return found.select(
        "doc_id", "file", "row", "number",
        (F.coalesce(taken, F.lit(0)) + F.col("gap")).cast("long").alias("start"),
        "value", "left", "right",
    )


def _luhn() -> Column:
    """Whether the digits have a valid check digit, as card numbers do."""
    digits = F.reverse(F.split(F.regexp_replace("value", "[^0-9]", ""), ""))

    def weight(d: Column, i: Column) -> Column:
        twice = F.try_to_number(d, F.lit("9")).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.coalesce(F.when(twice > 9, twice - 9).otherwise(twice), F.lit(0))

    total = F.aggregate(F.transform(digits, weight), F.lit(0), lambda a, b: a + b)
    return F.col("value").rlike("^[0-9]{13,19}$") & (total % 10 == 0)


def with_features(found: DataFrame) -> DataFrame:
    """The candidates with one double column for each name in ``FEATURES``."""
    value, left, right = F.col("value"), F.col("left"), F.col("right")
    length = F.length(value).cast("double")

    def share(characters: str) -> Column:
        return F.regexp_count(value, F.lit(characters)) / length

    words = "|".join(sorted(DICTIONARY, key=lambda w: (-len(w), w)))
    uncovered = F.length(F.regexp_replace(F.lower(value), words, ""))
    made = {
        "length": length,
        "hex_share": share("[0-9a-f]"),
        "digit_share": share("[0-9]"),
        "upper_share": share("[A-Z]"),
        "lower_share": share("[a-z]"),
        "distinct_share": F.size(F.array_distinct(F.split(value, ""))) / length,
        "transitions": share("(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[a-z])(?=[A-Z])"),
        "letter_runs": share("[A-Za-z]{4,}"),
        "dictionary_share": 1.0 - uncovered / length,
        "only_digits": value.rlike("^[0-9]+$"),
        "luhn": _luhn(),
        "in_path": left.rlike(r"[/\\.]$") | right.rlike(r"^[/\\.][A-Za-z0-9]") | value.rlike("/.*/"),
        "in_address": left.rlike(r"(?i)(?:https?://|www\.|@)\S*$"),
        "keyed": left.rlike(KEYED),
        "assigned": left.rlike(r"[:=]\s*[\"'`]?$"),
        "quoted": left.rlike("[\"'`]$") & right.rlike("^[\"'`]"),
        "key_word_near": left.rlike(rf"(?i)\b(?:{KEY_NAMES})\b"),
        "left_words": F.regexp_count(left, F.lit(r"(?<![^\s])[\p{L}]+[.,]?(?![^\s])")),
        "right_words": F.regexp_count(right, F.lit(r"(?<![^\s])[\p{L}]+[.,]?(?![^\s])")),
        "provider": value.rlike(PROVIDER),
    }
    return found.select(
        "*", *[F.coalesce(made[n].cast("double"), F.lit(0.0)).alias(n) for n in FEATURES]
    )


def weak_labels(found: DataFrame) -> DataFrame:
    """``label`` for candidates (with features) whose kind is beyond doubt; the others are left out."""
    secret = (F.col("provider") == 1) | (
        (F.col("keyed") == 1) & (F.col("dictionary_share") < 0.5) & (F.col("only_digits") == 0)
    )
    false = (F.col("key_word_near") == 0) & (F.col("provider") == 0) & (
        (F.col("luhn") == 1) | (F.col("in_address") == 1) | (F.col("only_digits") == 1)
        | (F.col("dictionary_share") >= 0.5) | (F.col("assigned") == 0)
    )
    return found.withColumn("label", F.when(secret, 1.0).when(false, 0.0)).filter(
        "label IS NOT NULL"
    )


def scored(
    found: DataFrame, labelled: DataFrame, train_most: int = TRAIN_MOST,
    features: Sequence[str] = FEATURES,
) -> DataFrame:
    """``found`` (with features) and the ``probability`` that each candidate is a secret."""
    rows = labelled.groupBy("label").count().collect()
    if len(rows) < 2:
        return found.withColumn("probability", F.lit(rows[0]["label"] if rows else 1.0))
    order = F.xxhash64("value", "left", "right")
    sample = labelled.select(*features, "label", order.alias("key")).orderBy(
        "key", *features, "label"
    ).limit(train_most)
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt",
        probabilityCol="chances",
    )
    model = forest.fit(assembler.transform(sample).select("features", "label"))
    return model.transform(assembler.transform(found)).select(
        *found.columns, vector_to_array("chances")[1].alias("probability")
    )


def _judged(rows: DataFrame, doc_id: str, text: str, file: str, row: str, labelled) -> DataFrame:
    found = stored(with_features(candidates(rows, doc_id, text, file, row)), "secret-candidates")
    marks = weak_labels(found) if labelled is None else with_features(labelled)
    return scored(found, marks)


def scan(
    documents: DataFrame, labelled: DataFrame | None = None, threshold: float = THRESHOLD,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per candidate: where it is, its digest, its probability and the verdict."""
    file, row = free_names(documents, "file", "row")
    judged = _judged(located(documents, file, row), doc_id, text, file, row, labelled)
    kind = (
        F.when(F.col("provider") == 1, "provider_key").when(F.col("keyed") == 1, "keyed_value")
        .when(F.col("luhn") == 1, "card_number").when(F.col("only_digits") == 1, "number")
        .otherwise("token")
    )
    return judged.select(
        "doc_id", "start", F.col("length").cast("long").alias("length"), kind.alias("kind"),
        F.sha2("value", 256).alias("value_sha256"), F.round("probability", 6).alias("probability"),
        (F.col("probability") >= threshold).alias("is_secret"),
    )


def redact(
    documents: DataFrame, labelled: DataFrame | None = None, threshold: float = THRESHOLD,
    doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars",
) -> DataFrame:
    """``documents`` with every secret replaced; ``n_chars``, if there, counts the new text."""
    file, row, spots = free_names(documents, "secret_file", "secret_row", "secret_spots")
    rows = located(documents, file, row)
    judged = _judged(rows, doc_id, text, file, row, labelled)
    found = stored(
        judged.filter(F.col("probability") >= threshold).groupBy("file", "row").agg(
            F.sort_array(F.collect_set("number")).alias(spots)
        ).select(F.col("file").alias(file), F.col("row").alias(row), spots),
        "secret-spots",
    )
    joined = rows.join(found, [file, row], "left")
    body = named(joined, text)
    clean = F.array_join(F.transform(
        parts(body),
        lambda p, i: F.when(F.array_contains(F.col(spots), i), F.lit(REDACTED)).otherwise(p),
    ), "")
    new = F.when(F.col(spots).isNotNull(), clean).otherwise(body)
    columns = []
    for name in documents.columns:
        if name == text:
            columns.append(new.alias(name))
        elif name == n_chars:
            changed = F.length(new).cast(documents.schema[name].dataType)
            columns.append(
                F.when(F.col(spots).isNotNull(), changed).otherwise(named(joined, name)).alias(name)
            )
        else:
            columns.append(named(joined, name))
    return joined.select(*columns)
