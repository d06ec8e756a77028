"""Secret scan: candidate strings by pattern, false positives removed by a random forest.

DataFrame functions and Spark ML only. Features: length, character classes and the changes
between them, share of the candidate that usual words of the corpus cover, whether it stands in
a path or address, and the words beside it, hashed into buckets.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchprofile.llm.common import SPACE, materialize

_NAME = "(?:token|secret|passw(?:or)?d|pwd|credential|key)"
#: What a credential's name is assigned: a quoted value, or one up to white space or a separator. The short looks back come first: they are cheap.
_VALUE = (r"(?<=[\s:=>\"'])(?=[^\s\"'=])(?<=[:=>]\s{0,4}[\"']?)(?<=(?i:" + _NAME + r")[\"']?\s{0,4}(?:=>|:=|[:=])\s{0,4}[\"']?)"
          r"(?:(?<=\")[^\"\r\n]{6,}+(?=\")|(?<=')[^'\r\n]{6,}+(?=')|(?<![\"'])[^\s\"',;&<>]{6,})")
#: Such a value of at least six characters, or a run of at least 16 characters that keys and tokens are made of; ``=`` only pads its end.
CANDIDATE = _VALUE + r"|(?<![A-Za-z0-9+/_.-])[A-Za-z0-9+/_.-]{16,}={0,2}(?![A-Za-z0-9+/_=.-])"
#: Names that stand before a credential.
NAMES = r"(?i)" + _NAME + r"[\"']?\s*(?:[:=]|=>|:=)?\s*[\"']?$"
ASSIGNED = r"[:=]\s*[\"']?$"
#: Words that stand before what is published on purpose; they only label, the forest sees hashed words.
PUBLIC = r"(?i)(?:sha-?\d*|md5|commit|checksum|hash|revision|version)\W*$"
FEATURES = ["length", "digits", "upper", "lower", "marks", "changes", "run", "covered", "path", "named", "assigned", "quoted", "near"]


@dataclass(frozen=True)
class Config:
    """``words``: usual words of the corpus that make the dictionary; ``findings``: labelled findings of each label the forest is
    fitted on at most (hash order); ``near``: buckets of the words beside a candidate; ``least``: probability from which a finding is kept."""

    words: int = 400
    findings: int = 5_000
    trees: int = 20
    near: int = 32
    depth: int = 6
    least: float = 0.5


def dictionary(docs: DataFrame, c: Config = Config()) -> list[str]:
    """The usual words of all documents: three to twelve letters, by count, ties in code-point order."""
    words = docs.select(F.explode(F.split(F.lower(F.col("text")), SPACE)).alias("w")).where(F.col("w").rlike("^[a-z]{3,12}$"))
    top = words.groupBy("w").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").limit(c.words)
    return [r.w for r in top.collect()]  # at most c.words


def candidates(docs: DataFrame) -> DataFrame:
    """``doc_id, nth, candidate, before, after``: every candidate of every whole text with up to 48 characters on either side.

    Null and empty texts have none. Rows that repeat a ``doc_id`` are scanned each for itself.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).where(F.col("text").rlike(CANDIDATE))
    found = rows.select("doc_id", F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("c"), F.split("text", CANDIDATE, -1).alias("s"))
    slim = found.select("doc_id", "c", F.transform("s", lambda x: F.struct(F.right(x, F.lit(48)).alias("r"), F.substring(x, 1, 48).alias("l"))).alias("s"))
    each = slim.select("doc_id", F.posexplode(F.transform("c", lambda x, i: F.struct(x.alias("candidate"), F.get("s", i)["r"].alias("before"), F.get("s", i + 1)["l"].alias("after")))).alias("nth", "f"))
    return each.select("doc_id", F.col("nth").cast("long").alias("nth"), "f.candidate", F.coalesce("f.before", F.lit("")).alias("before"), F.coalesce("f.after", F.lit("")).alias("after"))


def _share(pattern: str) -> Column:
    return F.length(F.regexp_replace("candidate", pattern, "")) / F.length("candidate")


def near_words(buckets: int) -> Column:
    """A vector with 1 in the bucket of each of the three words before a candidate and the two behind it (letters only, lower-cased, either side by itself)."""
    said = lambda side: F.filter(F.split(F.lower(side), "[^a-z]+"), lambda w: w != "")
    before, after = said("before"), F.slice(said("after"), 1, 2)
    last = F.slice(F.reverse(before), 1, 3)
    at = lambda mark: lambda w: F.pmod(F.xxhash64(F.lit(mark), w), F.lit(buckets)).cast("int")
    met = F.concat(F.transform(last, at("b")), F.transform(after, at("a")))
    return array_to_vector(F.array(*(F.when(F.array_contains(met, i), 1.0).otherwise(0.0) for i in range(buckets))))


def with_features(found: DataFrame, words: list[str], buckets: int = Config.near) -> DataFrame:
    low = F.lower("candidate")
    usual = "|".join(sorted(words, key=lambda w: (-len(w), w)))
    covered = 1 - F.length(F.regexp_replace(low, usual, "")) / F.length("candidate") if words else F.lit(0.0)
    flag = lambda c: F.when(c, 1.0).otherwise(0.0)
    return found.withColumns({
        "length": F.least(F.length("candidate"), F.lit(400)).cast("double"), "digits": _share("[^0-9]"), "upper": _share("[^A-Z]"), "lower": _share("[^a-z]"), "marks": _share("[A-Za-z0-9]"),
        "changes": F.regexp_count("candidate", F.lit("(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[a-z])(?=[A-Z])")) / F.length("candidate"),
        "run": F.regexp_count(low, F.lit("[bcdfghjklmnpqrstvwxz]{4}")) / F.length("candidate"),
        "covered": covered,
        "path": flag(F.col("before").rlike(r"[/\\@?&]$|(?i)https?:\S*$|www\.\S*$") | F.col("candidate").rlike(r"/.*/|\.[a-z]{2,4}$") | F.col("after").rlike(r"^[/\\@]")),
        "named": flag(F.col("before").rlike(NAMES)), "assigned": flag(F.col("before").rlike(ASSIGNED)),
        "quoted": flag(F.col("before").rlike("[\"'`]$") & F.col("after").rlike("^[\"'`]")), "public": flag(F.col("before").rlike(PUBLIC)), "near": near_words(buckets),
    })


def labelled(found: DataFrame) -> DataFrame:
    """Findings with a ``label``, from what can be told for certain: 1 for a value of letters and digits assigned to a credential's name,
    0 for a run without digits or one that stands behind a word for what is public; others have no label, also values without digits but
    with marks that are assigned to a credential's name."""
    c = F.col("candidate")
    mixed = c.rlike("[0-9]") & c.rlike("[A-Za-z]")
    unsure = ~c.rlike("[0-9]") & c.rlike(r"[^A-Za-z\s]") & (F.col("named") == 1) & (F.col("assigned") == 1)
    label = (F.when(mixed & (F.col("named") == 1) & (F.col("public") == 0), 1.0)
             .when(~unsure & (~c.rlike("[0-9]") | (F.col("public") == 1) | ((F.col("path") == 1) & (F.col("named") == 0))), 0.0))
    return found.withColumn("label", label).where("label IS NOT NULL")


def fit(findings: DataFrame, c: Config = Config()) -> RandomForestClassificationModel | None:
    """The forest, from labelled findings (``label`` and FEATURES); None when a label is missing."""
    h = F.xxhash64(F.lit(3), "candidate", "before", "after")
    some = None
    for label in (0.0, 1.0):
        part = findings.where(F.col("label") == label).select("label", *FEATURES, h.alias("_h")).orderBy("_h", *FEATURES[:-1]).limit(c.findings)
        some = part if some is None else some.unionByName(part)
    some = materialize(some.drop("_h"), "secret-sample")
    if some.select("label").distinct().count() < 2:
        return None
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(some)
    return RandomForestClassifier(numTrees=c.trees, maxDepth=c.depth, seed=17, subsamplingRate=0.8).fit(rows)


def score(found: DataFrame, model: RandomForestClassificationModel | None, c: Config = Config()) -> DataFrame:
    """``doc_id, nth, sha256, masked, n_chars, score, kept``: the candidate itself is not given on, only a quarter of it at most,
    four characters. Without a model the score is 1."""
    if model is None:
        rows = found.withColumn("score", F.lit(1.0))
    else:
        rows = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found)).withColumn("score", vector_to_array("probability")[1])
    return rows.select("doc_id", "nth", F.sha2("candidate", 256).alias("sha256"), F.concat(F.expr("left(candidate, int(least(4, length(candidate) div 4)))"), F.lit("...")).alias("masked"),
                       F.length("candidate").cast("long").alias("n_chars"), "score", (F.col("score") >= c.least).alias("kept"))


def scan(docs: DataFrame, c: Config = Config()) -> DataFrame:
    """Every candidate of every whole text with its score and verdict. The forest learns from the findings that can be told for certain;
    the dictionary counts all documents."""
    words = dictionary(docs, c)
    found = materialize(with_features(candidates(docs), words, c.near), "secret-candidates")
    return score(found, fit(labelled(found), c), c)
