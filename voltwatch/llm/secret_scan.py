"""Secret scan: patterns propose findings, a random forest removes the false ones.

A candidate is a run of at least 16 letters, digits and ``_+/-`` (ASCII, ``=`` only as padding at its end) that has a
digit, or the value given to a name that says it is a credential, of any characters from ``LEAST_NAMED`` on: up to the
closing quote, or without quotes up to a space or a sign that ends values. Places that both find count once. Its features
are length, shares of digits and capitals, changes between letters, digits and cases, distinct characters, dictionary
coverage (share of its letter trigrams that occur in the corpus's frequent words, counted over all documents), the path
it stands in, and words next to it.

The forest learns from labelled findings: ``labelled`` gives those that a rule can tell for sure, from at most about
``FIT_ROWS`` of them, chosen by a hash of the document's id. Every candidate of every whole text is scored. A caller with
labels of their own passes them instead.

Cases: null and empty texts have no candidates; a null path counts as none; repeated rows each give their findings;
without findings of both labels every score is 0.5 and no finding is a secret; an empty table gives no rows; other
columns are ignored. Secrets themselves are not put out, only their places and digests.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltwatch.llm.bpe import lexicon
from voltwatch.llm.common import frozen
from voltwatch.llm.pii import place

_RUN = "[A-Za-z0-9_+/-]"
_PADDED = "(?![A-Za-z0-9_+/=-])"  # an equals sign before anything else assigns
CANDIDATE = rf"(?<!{_RUN})(?=[A-Za-z_+/-]*[0-9])(?:{_RUN}{{16,}}(?:={{1,2}}{_PADDED})?|{_RUN}{{15}}={{1,2}}{_PADDED}|{_RUN}{{14}}=={_PADDED})"
#: Characters of a named value at least: what is shorter keeps no secret.
LEAST_NAMED = 4
_NAMES = "token|secret|key|passw|auth|credential|api"
_GIVEN = r"[\"']?\s*+(?::=|=>|[=:])\s*+[\"']?"
#: A name and what stands between it and its value; and both with the value. A name is read once, from its start.
_BEFORE = rf"(?<![\w.-])(?=[\w.-]*?(?i:{_NAMES}))[\w.-]++{_GIVEN}"
_PLAIN = r"[^\s\"'`&,;<>(){}\[\]]"
_VALUE = rf"(?<=\")[^\"\r\n]{{{LEAST_NAMED},}}+(?=\")|(?<=')[^'\r\n]{{{LEAST_NAMED},}}+(?=')|(?![=:>]|\w*(?i:{_NAMES})[\w.-]*+{_GIVEN}{_PLAIN}){_PLAIN}{{{LEAST_NAMED},}}(?<![.:])"
NAMED = rf"{_BEFORE}(?:{_VALUE})"
#: Frequent words that make the dictionary, labelled findings in the fit about, trees and depth.
DICTIONARY_WORDS, FIT_ROWS, TREES, DEPTH = 20_000, 20_000, 40, 8
NEAR_CHARS = 40
KEYWORD = rf"(?i)({_NAMES})[\w.-]*{_GIVEN}$"
ASSIGNED = r"(?:=>|[=:])\s*[\"']?$"
HARMLESS = r"(?i)example|sample|dummy|card|visa|phone|sha1|commit|uuid|isbn|order"
FEATURES = ["size", "digits", "capitals", "changes", "cases", "distinct", "hex", "numeric", "luhn", "coverage", "depth", "test_path", "keyword", "assigned", "harmless", "quoted"]


def candidates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """A row a candidate: ``id_col``, path, start, end (code points, end exclusive), x, before, next."""
    path = F.coalesce(F.col(path_col), F.lit("")) if path_col else F.lit("")
    held = df.select(F.col(id_col), path.alias("path"), F.col(text_col).alias("text")).where(F.col("text").rlike(CANDIDATE) | F.col("text").rlike(NAMED))
    value = lambda s: F.regexp_replace(s.x, rf"^{_BEFORE}", "")
    named = F.transform(place(F.col("text"), NAMED), lambda s: F.struct((s.end - F.length(value(s))).alias("start"), s.end.alias("end"), value(s).alias("x")))
    found = held.select("*", F.explode(F.array_union(place(F.col("text"), CANDIDATE), named)).alias("c"))
    first = F.greatest(F.col("c.start") - NEAR_CHARS, F.lit(0))
    return found.select(
        id_col, "path", "c.start", "c.end", "c.x",
        F.substring("text", (first + 1).cast("int"), (F.col("c.start") - first).cast("int")).alias("before"),
        F.substring("text", (F.col("c.end") + 1).cast("int"), F.lit(1)).alias("next"),
    )


def dictionary(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Letter trigrams of the most frequent words of all texts (``DICTIONARY_WORDS`` words, so a bounded table)."""
    grams = sorted({w[k : k + 3] for w in lexicon(df, text_col, DICTIONARY_WORDS) for k in range(len(w) - 2)})
    return df.sparkSession.createDataFrame([(g,) for g in grams], "gram string")


def with_features(found: DataFrame, grams: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The candidates with the columns of ``FEATURES``. What hangs on the string alone is worked out once a string."""
    x = F.col("x")
    each = lambda pattern: F.regexp_count(x, F.lit(pattern)).cast("double")
    strings = found.select("x").distinct()
    pieces = strings.select("x", F.explode(F.transform(F.sequence(F.lit(1), F.length(x) - 2), lambda k: F.lower(F.substring(x, k, F.lit(3))))).alias("gram"))
    known = pieces.join(F.broadcast(grams.withColumn("known", F.lit(1))), "gram", "left").groupBy("x").agg((F.count("known") / F.count("*")).alias("coverage"))
    of_string = known.select(
        "x", "coverage",
        F.length(x).cast("double").alias("size"),
        (each("[0-9]") / F.length(x)).alias("digits"),
        (each("[A-Z]") / F.length(x)).alias("capitals"),
        (each("(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])") / F.length(x)).alias("changes"),
        (each("(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])") / F.length(x)).alias("cases"),
        (F.size(F.array_distinct(F.split(x, ""))) / F.length(x)).alias("distinct"),
        x.rlike("^[0-9a-fA-F]+$").cast("double").alias("hex"),
        x.rlike("^[0-9]+$").cast("double").alias("numeric"),
        F.when(x.rlike("^[0-9]{13,19}$"), F.call_function("luhn_check", x).cast("double")).otherwise(0.0).alias("luhn"),
    )
    b = F.col("before")
    return found.join(of_string, "x").select(
        id_col, "start", "end", *of_string.columns,
        F.regexp_count("path", F.lit("/")).cast("double").alias("depth"),
        F.col("path").rlike(r"(?i)test|example|sample|doc").cast("double").alias("test_path"),
        b.rlike(KEYWORD).cast("double").alias("keyword"),
        b.rlike(ASSIGNED).cast("double").alias("assigned"),
        b.rlike(HARMLESS).cast("double").alias("harmless"),
        F.col("next").isin("'", '"').cast("double").alias("quoted"),
    )


def labelled(rows: DataFrame) -> Column:
    """1 for a sure secret, 0 for a sure false finding, else null: a value given to a named credential that is no number
    and no word; a checked or plain number, or what stands in words or has no assignment around it."""
    f = {c: F.col(c) for c in FEATURES}
    secret = (f["keyword"] == 1) & (f["harmless"] == 0) & (f["numeric"] == 0) & (f["coverage"] < 0.5)
    false = (f["keyword"] == 0) & ((f["luhn"] == 1) | (f["numeric"] == 1) | (f["coverage"] >= 0.8) | ((f["assigned"] == 0) & (f["hex"] == 0)))
    return F.when(secret, 1.0).when(false, 0.0)


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source", labels: DataFrame | None = None) -> DataFrame:
    """``id_col``, start, end, sha256, label (what the rules say, or null), score, is_secret of every candidate.

    ``labels`` (``id_col``, start, end, label) replaces the rules' labels in the fit.
    """
    found = candidates(df, id_col, text_col, path_col)
    rows = frozen(with_features(found, dictionary(df, text_col), id_col))  # read by the fit and by the scores
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows.withColumn("label", labelled(rows)))
    known = rows.join(labels.select(id_col, "start", "end", F.col("label").cast("double").alias("given")), [id_col, "start", "end"]).withColumn("label", F.col("given")) if labels else rows.where("label IS NOT NULL")
    sizes = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    out = [id_col, "start", "end", F.sha2(F.encode("x", "UTF-8"), 256).alias("sha256"), F.col("label").cast("int").alias("label")]
    if not sizes.get(0.0) or not sizes.get(1.0):
        return rows.select(*out, F.lit(0.5).alias("score"), F.lit(False).alias("is_secret"))
    # half the rows of the fit from either label; a hash decides
    share = F.create_map(*(v for k, n in sizes.items() for v in (F.lit(k), F.lit(min(1.0, FIT_ROWS / 2 / n)))))
    drawn = F.pmod(F.xxhash64(F.lit("secrets"), id_col, "start"), F.lit(1_000_000)) < share[F.col("label")] * 1_000_000
    sample = known.where(drawn).select(id_col, "start", "features", "label").repartition(1).sortWithinPartitions(id_col, "start")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=11, featuresCol="features", labelCol="label", probabilityCol="probability").fit(sample)
    scored = forest.transform(rows)
    score = vector_to_array("probability")[1]
    return scored.select(*out, F.round(score, 6).alias("score"), (score >= 0.5).alias("is_secret"))
