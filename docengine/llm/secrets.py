"""Secret scans: candidates by form, a random forest on top against false positives.

A candidate is found anywhere in a text: a value of six characters or more under a name (blanks
around `=` or `:`, quotes and brackets may stand there), or a free value of twelve or more with a
digit, without the quotes and punctuation around it. Its features are its value's length, the
changes between kinds of characters, the kinds' shares and the distinct characters, the part
covered by words of a dictionary, the path (the document's source and the place in its text),
its name and its neighbouring words. The forest is trained on labelled findings, at most
`TRAINED` of them, drawn by a seeded hash; all candidates are scored.

Defined cases: null text has no candidates; without labelled findings of both kinds there is no
forest, every candidate scores 0.5 and is_secret is null: not judged; the dictionary has at most `DICTIONARY` words; repeated rows give
repeated findings. Everything on the data is SQL functions and Spark's own forest.
"""

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DICTIONARY = 500
TRAINED = 10_000
LEAD = r"""[A-Za-z][A-Za-z0-9_.-]{1,63}+["'`]?[ \t]*+(?::=|=>|==?|:)[ \t]*+"""
NEXT = r"""[A-Za-z][A-Za-z0-9_.-]{0,63}+(?:["'`][ \t]*+:|[ \t]++[=:]|[=:](?=[^\s=]))"""
VALUE = (  # in quotes, or up to a blank, a quote or the next assignment
    r"""(?:"[^"\r\n=:]{6,100}+"|'[^'\r\n=:]{6,100}+'|["'`(\[{<]{0,3}+(?!NEXT)(?=[^\s"'`]{6})"""
    r"""[^\s"'`,;&]*+(?:[,;&]++(?!NEXT)[^\s"'`,;&]++){0,99}+["'`]?)"""
).replace("NEXT", NEXT)
ASSIGNED = rf"(?<![A-Za-z0-9_.-]){LEAD}{VALUE}"
STANDING = (
    r"(?<![A-Za-z0-9+/_=.@-])(?=AKIA[A-Z0-9]{16}|[A-Za-z+/_=.-]*+[0-9])"
    r"[A-Za-z0-9+/_=.-]{12,}+(?!@)"
)
CANDIDATE = f"{ASSIGNED}|{STANDING}"
NAME = r"""^([A-Za-z][A-Za-z0-9_.-]{1,63}+)(?=["'`]?[ \t]*+(?::=|=>|==?|:)[ \t]*+[^\s=])"""
EDGES = r"""^["'`(\[{<]+|["'`.,;:!?)\]}>#$%&*]+$"""
SECRET_NAME = r"(?i)(pass|pwd|secret|token|key|auth)"
ACCESS_KEY = r"^AKIA[A-Z0-9]{16}$"
ISSUED = r"^(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9+/_=-]{16,}$"
FEATURES = [
    "size", "changes", "digits", "uppers", "lowers", "others", "distinct", "covered",
    "path", "place", "named", "name_fits", "before_size", "after_size", "before_plain",
]


def dictionary(texts: DataFrame) -> list[str]:
    """The most frequent words of three letters or more; `texts` has one text column."""
    words = texts.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\b\p{L}{3,}\b"), 0)).alias("w"))
    top = words.groupBy("w").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").limit(DICTIONARY)
    return [r["w"] for r in top.select("w").collect()]


def findings(documents: DataFrame, words: list[str]) -> DataFrame:
    """doc_id, word_no, candidate, value and `FEATURES`: a row per candidate.

    `word_no` is the number of the word that the candidate starts in.
    """
    matches = F.regexp_extract_all("text", F.lit(CANDIDATE), 0)
    rows = documents.select("doc_id", "source", "text", matches.alias("found"))
    rows = rows.where(F.size("found") > 0).select(
        "doc_id",
        "source",
        "found",
        F.split("text", CANDIDATE, -1).alias("gaps"),  # one more than found
        F.regexp_count("text", F.lit(r"\S+")).alias("n_words"),
    )
    # Words that end in each candidate and in the gap before it; a later gap starts in a word.
    ends = F.transform(
        F.sequence(F.lit(0), F.size("found") - 1),
        lambda i: F.regexp_count(
            F.concat(
                F.when(i > 0, F.get("found", i - 1)).otherwise(F.lit("")), F.get("gaps", i)
            ),
            F.lit(r"\S\s"),
        ),
    )
    numbers = F.aggregate(
        ends,
        F.array().cast("array<int>"),
        lambda done, n: F.array_append(done, n + F.coalesce(F.get(done, F.size(done) - 1), F.lit(0))),
    )
    rows = rows.withColumn("numbers", numbers).select(
        "doc_id", "source", "found", "gaps", "numbers", "n_words", F.posexplode("found").alias("at", "candidate")
    )
    rows = rows.select(
        "doc_id",
        F.get("numbers", F.col("at")).alias("word_no"),
        "candidate",
        F.regexp_extract(F.get("gaps", F.col("at")), r"(\S*)\s*$", 1).alias("before"),
        F.regexp_extract(F.get("gaps", F.col("at") + 1), r"^\s*(\S*)", 1).alias("after"),
        (F.get("numbers", F.col("at")) / F.col("n_words")).alias("place"),
        (F.pmod(F.xxhash64("source"), F.lit(64))).cast("double").alias("path"),
    )
    rows = rows.withColumn("name", F.regexp_extract("candidate", NAME, 1))
    value = F.when(
        F.col("name") != "", F.regexp_replace("candidate", f"^{LEAD}", "")
    ).otherwise(F.col("candidate"))
    rows = rows.withColumn("value", F.regexp_replace(value, EDGES, ""))
    kinds = F.translate("value", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "A" * 26)
    kinds = F.translate(kinds, "abcdefghijklmnopqrstuvwxyz", "a" * 26)
    kinds = F.translate(kinds, "0123456789", "0" * 10)
    size = F.greatest(F.length("value"), F.lit(1))

    def share(pattern: str) -> Column:
        return F.regexp_count("value", F.lit(pattern)) / size

    known = "|".join(sorted(words, key=lambda w: (-len(w), w))) or "(?!)"
    rows = rows.withColumn("kinds", kinds)
    return rows.withColumns(
        {
            "size": F.length("value"),
            "changes": F.length(F.regexp_replace("kinds", r"(.)\1+", "$1")) / size,
            "digits": share("[0-9]"),
            "uppers": share("[A-Z]"),
            "lowers": share("[a-z]"),
            "others": share("[^A-Za-z0-9]"),
            "distinct": F.size(F.array_distinct(F.split("value", ""))) / size,
            "covered": (size - F.length(F.regexp_replace(F.lower("value"), known, ""))) / size,
            "named": (F.col("name") != "").cast("double"),
            "name_fits": F.col("name").rlike(SECRET_NAME).cast("double"),
            "before_size": F.length("before"),
            "after_size": F.length("after"),
            "before_plain": F.col("before").rlike(r"^\p{L}+[.,]?$").cast("double"),
        }
    ).select("doc_id", "word_no", "candidate", "value", *(F.col(f).cast("double").alias(f) for f in FEATURES))


def scan(
    documents: DataFrame,
    labelled: DataFrame,
    words: list[str],
    limit: float = 0.5,
    seed: int = 7,
) -> DataFrame:
    """doc_id, word_no, candidate, score, is_secret: a row per candidate.

    `labelled` (doc_id, word_no, secret 0/1) has findings that were looked at, with `candidate`
    where several start in one word. is_secret is null where no forest could be fitted.
    """
    rows = findings(documents, words)
    vector = VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep")
    order = [F.xxhash64(F.lit(seed), "doc_id", "word_no"), "doc_id", "word_no"]
    known = labelled.where("secret is not null").orderBy(*order).limit(TRAINED)
    keys = [c for c in ("doc_id", "word_no", "candidate") if c in labelled.columns]
    known = known.select(*keys, F.col("secret").cast("double").alias("label"))
    train = vector.transform(rows.join(F.broadcast(known), keys))
    train = train.select("label", "features").cache()  # at most TRAINED findings
    kinds = {r["label"] for r in train.select("label").distinct().collect()}
    if kinds == {0.0, 1.0}:
        forest = RandomForestClassifier(
            numTrees=20, maxDepth=6, seed=seed, labelCol="label", featuresCol="features"
        ).fit(train)
        scored = forest.transform(vector.transform(rows)).withColumn(
            "score", vector_to_array("probability")[1]
        )
        verdict = F.col("score") >= limit
    else:
        scored = rows.withColumn("score", F.lit(0.5))
        verdict = F.lit(None).cast("boolean")
    train.unpersist()
    return scored.select("doc_id", "word_no", "candidate", "score", verdict.alias("is_secret"))


def reviewed(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, word_no, candidate, secret: candidates of the documents that `labels` covers.

    The given tables have no reviews of findings; what a review would say follows here from
    the forms: an access key, or a value of 16 letters and digits or more under a secret's
    name, is a secret; another value under such a name is in doubt (null); addresses, numbers,
    dates, plain hashes and values under other names are none.
    """
    issued = (F.col("name_fits") == 1) & F.col("value").rlike(ISSUED)
    found = findings(documents, []).select(
        "doc_id",
        "word_no",
        "candidate",
        F.when(issued | F.col("value").rlike(ACCESS_KEY), 1)
        .when(F.col("name_fits") == 0, 0)
        .alias("secret"),
    )
    # No semi join: that would be taken below the findings and shuffle whole texts.
    return found.join(labels.select("doc_id").distinct(), "doc_id")
