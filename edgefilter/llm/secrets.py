"""Secret scan: candidates by pattern, false positives removed by a random forest.

Only DataFrame functions and Spark ML run on the main path.

1. Candidates are runs of 16 or more key-like characters with a digit among
   them, values of 8 or more that are assigned to a credential's name, in quotes
   or not, and private keys from BEGIN to END (the header alone if there is no
   end), all of any length. A key's first and last line are paired by their
   places. The name before "=" is no part of a candidate. A text is cut at its
   candidates, so each has the words before and after it at hand.
2. Features of a candidate: length; character transitions (changes of class,
   distinct characters, entropy, hex only, shares of digits and capitals);
   dictionary coverage (share of its letters that are among the corpus's most
   frequent words, counted over all documents); path (slashes, dots, what it
   is joined to); neighbouring words (credential names, assignment, quotes,
   names of hashes and examples).
3. A random forest is trained on labelled findings, a bounded sample of them.
   Where no labelled table is given, rules label the sure cases: assigned in
   quotes to a credential's name and mixed in its characters, or so without
   quotes, with a digit and nothing that speaks against it (1); digits only,
   part of a host, path or address, or named as a hash, number or example (0).
   The rest stay unlabelled and get the forest's vote. What scores under one
   half is dropped as a false positive.

Defined cases: very long texts and findings are searched and replaced whole; columns
of the input that clash with those of the result don't matter to ``scan`` (it
carries the id only) and stay in ``redact``; an empty table has no finding; null or empty texts have no finding; a candidate that stands
several times in a text is one finding with its best score and a count; equal
rows (same id and text) are one; null ids are kept as null; without both labels
to learn from, the rules' label is the score (0.5 where they have none).
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edgefilter.llm.common import NARROW_ROW, by_rows, fresh, hash_share, register, table
from edgefilter.session import materialize

#: Names that credentials go by, and names of what is not one.
CREDENTIAL = r"(?i)(?:token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|auth|bearer|credentials?|private)"
HARMLESS = r"(?i)\b(?:commit|sha-?\d*|md5|hash|checksum|digest|uuid|guid|example|sample|dummy|phone|card|isbn|http|www)\b"
ASSIGNED = CREDENTIAL + r"\w*[\"']?\s*[:=]\s*[\"']?$"
# Stricter, for values without quotes: the name ends there, or goes on after _ or - or with a capital ("author" is none).
_WORDS = r"(?i:token|secret|passw(?:or)?d|passwd|passphrase|pwd|api[_-]?key|access[_-]?key|private[_-]?key)"
_NAME, _SIGN = _WORDS + r"(?:[_-]\w*|[A-Z]\w*)?", r"[\"']?\s*[:=]\s*"
ASSIGNED_PLAIN = _NAME + _SIGN + "$"
# What stands before a value can be looked at over a bounded stretch only; this is the layout of an assignment (how
# long its name goes on, how much space is in it), not of what is assigned.
_BEHIND = _WORDS + r"(?:[_-]\w{0,80}|[A-Z]\w{0,80})?[\"']?\s{0,8}[:=]\s{0,8}"
#: First and last line of a private key. What lies between is found by their places, however long it is.
MARK = r"-----(?:BEGIN|END) [A-Z0-9 ]*?PRIVATE KEY(?: BLOCK)?-----"
PATTERN = (
    # a value assigned in quotes, and one without (a digit in it, or no space before it; no variable, no comparison)
    rf"(?<=[\"'])(?<={_BEHIND}[\"'])[^\s\"']{{8,}}"
    rf"|(?<=[:=\s])(?<=[:=]\s{{0,8}})(?![=:>~]|\$[{{(A-Za-z_]|\{{\{{)(?:(?<=[:=])|(?=[^\s\"'&<>0-9]*+[0-9]))"
    rf"(?<={_BEHIND})[^\s\"'&<>]{{7,}}[^\s\"'&<>,;.)\]}}]"
    # a run with a digit; "=" only ends it, and a credential's name that is assigned to is none
    r"|(?<![A-Za-z0-9_+/.-])(?=[A-Za-z_+/.-]*+[0-9])"
    rf"(?![A-Za-z0-9_.-]*?{_NAME}{_SIGN}[^\s=])"
    r"[A-Za-z0-9_+/.-]{16,}(?:={1,2}(?![A-Za-z0-9_+/.=\"'-]))?")
#: Frequent words kept as the dictionary, a bound that the corpus doesn't change; their length in letters.
DICTIONARY_WORDS, DICTIONARY_LETTERS = 2000, (4, 12)
#: Bound of the labelled findings to learn from (about).
SAMPLE_FINDINGS = 20_000
TREES, DEPTH = 30, 6
THRESHOLD = 0.5
REDACTED = "[SECRET]"

FEATURES = ["length", "transitions", "distinct", "entropy", "hex", "digits", "capitals", "coverage", "slashes", "dots",
            "joined", "named", "assigned", "quoted", "harmless", "header"]


def dictionary(docs: DataFrame, text_col: str = "text", words: int = DICTIONARY_WORDS) -> list[str]:
    """The ``words`` most frequent words of all documents, ties by name."""
    low, high = DICTIONARY_LETTERS
    each = docs.select(F.explode(F.split(F.lower(F.col(text_col)), "[^a-z]+")).alias("w")).where(
        F.length("w").between(low, high))
    top = each.groupBy("w").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").limit(words)
    return [r["w"] for r in top.collect()]


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rid, doc_id, candidate, before, after): every candidate with the text around it."""
    text = F.col(text_col)
    marked = text.contains("PRIVATE KEY-----") | text.contains("PRIVATE KEY BLOCK-----")
    cut = docs.where(marked | text.rlike(PATTERN)).select(
        F.xxhash64(F.col(id_col), text).alias("rid"), F.col(id_col).alias("doc_id"), text.alias("whole"),
        F.when(marked, F.regexp_extract_all(text, F.lit(MARK), F.lit(0))).alias("marks"),
        F.when(marked, F.split(text, MARK, -1)).alias("gaps"))
    begins = lambda i: F.get("marks", i).startswith("-----BEGIN")
    ended = lambda i: F.coalesce(F.get("marks", i + 1).startswith("-----END"), F.lit(False))
    inside = lambda i: (i > 0) & F.coalesce(begins(i - 1), F.lit(False)) & ended(i - 1)
    # the text without what is inside its keys, and the keys: a first line up to the last line that comes next, or alone
    open_text = F.coalesce(F.array_join(F.transform("gaps", lambda g, i: F.concat(
        F.when(inside(i), F.lit("")).otherwise(g), F.coalesce(F.get("marks", i), F.lit("")))), ""), F.col("whole"))
    tail = lambda x: F.when(F.length(x) > 60, F.substring(x, -60, 60)).otherwise(x)
    head = lambda x: F.substring(x, 1, 20)
    entry = lambda c, before, after: F.named_struct(
        F.lit("candidate"), c, F.lit("before"), before, F.lit("after"), after)
    firsts = F.filter(F.sequence(F.lit(0), F.size("marks") - 1), begins)
    keys = F.when(F.size("marks") > 0, F.transform(firsts, lambda i: entry(
        F.when(ended(i), F.concat(F.get("marks", i), F.get("gaps", i + 1), F.get("marks", i + 1))).otherwise(F.get("marks", i)),
        tail(F.get("gaps", i)), head(F.get("gaps", F.when(ended(i), i + 2).otherwise(i + 1))))))
    found = cut.select("rid", "doc_id", keys.alias("keys"), open_text.alias("open")).select(
        "rid", "doc_id", "keys", F.regexp_extract_all("open", F.lit(PATTERN), F.lit(0)).alias("found"),
        F.transform(F.split("open", PATTERN, -1), lambda x: F.named_struct(
            F.lit("tail"), tail(x), F.lit("head"), head(x))).alias("around"))
    others = F.transform("found", lambda c, k: entry(c, F.get("around", k)["tail"], F.get("around", k + 1)["head"]))
    every = F.when(F.col("keys").isNull(), others).otherwise(F.concat("keys", others))
    return found.select("rid", "doc_id", F.explode(every).alias("x")).select("rid", "doc_id", "x.*")


def with_features(found: DataFrame, words: list[str]) -> DataFrame:
    """The features of each candidate, and ``sure``: 1, 0 or null by the rules."""
    c, before, after = F.col("candidate"), F.col("before"), F.col("after")
    n = F.length(c)
    chars = F.split(c, "")
    counts = F.transform(F.array_distinct(chars), lambda d: n - F.length(F.replace(c, d, F.lit(""))))
    entropy = -F.aggregate(counts, F.lit(0.0), lambda acc, k: acc + (k / n) * F.log2(k / n))
    own_words = F.filter(F.split(F.lower(c), "[^a-z]+"), lambda w: w.isin(words) if words else F.lit(False))
    covered = F.aggregate(own_words, F.lit(0), lambda acc, w: acc + F.length(w)) / n
    number = lambda x: x.cast("double")
    near = F.regexp_extract(before, r"((?:\S+\s+){0,3}\S*)$", 1)
    out = found.select(
        "*", number(n).alias("length"),
        number(F.regexp_count(c, F.lit(r"(?<=[0-9])(?![0-9])|(?<=[a-z])(?![a-z])|(?<=[A-Z])(?![A-Z])")) / n)
        .alias("transitions"),
        number(F.size(F.array_distinct(chars)) / n).alias("distinct"), entropy.alias("entropy"),
        number(c.rlike("^[0-9a-fA-F]+$")).alias("hex"), number(F.regexp_count(c, F.lit("[0-9]")) / n).alias("digits"),
        number(F.regexp_count(c, F.lit("[A-Z]")) / n).alias("capitals"), number(covered).alias("coverage"),
        number(F.regexp_count(c, F.lit("/"))).alias("slashes"), number(F.regexp_count(c, F.lit(r"\."))).alias("dots"),
        number(before.rlike(r"[@/\\#]$") | after.rlike(r"^[@/\\]")).alias("joined"),
        number(near.rlike(CREDENTIAL)).alias("named"), number(before.rlike(ASSIGNED)).alias("assigned"),
        number(before.rlike("[\"']$") & after.rlike("^[\"']")).alias("quoted"),
        number(near.rlike(HARMLESS)).alias("harmless"), number(c.startswith("-----BEGIN")).alias("header"))
    mixed = (F.col("entropy") >= 2.5) & (F.col("coverage") < 0.5)
    yes = (F.col("header") > 0) | ((F.col("assigned") > 0) & (F.col("quoted") > 0) & mixed)
    plain = before.rlike(ASSIGNED_PLAIN) & mixed & (F.col("digits") > 0)
    no = (F.col("digits") == 1) | (F.col("joined") > 0) | (F.col("harmless") > 0) | c.rlike(
        r"\.[a-z]{2,4}$") | (F.col("coverage") >= 0.7)
    return out.withColumn("sure", F.when(yes, 1).when(no, 0).when(plain, 1))


def train(found: DataFrame, sample: int = SAMPLE_FINDINGS) -> RandomForestClassificationModel | None:
    """The forest of labelled findings (features and ``sure``), or None if they lack one of the labels."""
    labelled = found.where(F.col("sure").isNotNull())
    counts = {r["sure"]: r["count"] for r in labelled.groupBy("sure").count().collect()}
    if len(counts) < 2:
        return None
    # each label's share of hashes is set by its count, so a rare label is not drowned
    take = F.lit(False)
    key = F.concat_ws("\n", "doc_id", "candidate")
    for label, n in sorted(counts.items()):
        take = take | ((F.col("sure") == label) & hash_share(key, sample / 2 / n))
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(labelled.where(take)).select(
        "features", F.col("sure").cast("double").alias("label")).coalesce(4)
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=11, featureSubsetStrategy="onethird").fit(rows)


def scan(docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rid, doc_id, candidate, occurrences, score, is_secret) of every finding.

    ``labelled`` (candidate, before, after, label 0/1) takes the place of the rules' labels.
    """
    words = dictionary(docs, text_col)
    found = materialize(with_features(candidates(docs, id_col, text_col), words), "findings")
    known = found if labelled is None else materialize(with_features(labelled, words).withColumn(
        "sure", F.col("label").cast("int")).withColumn("doc_id", F.lit(None).cast("long")), "labelled")
    model = train(known)
    if model is None:
        scored = found.withColumn("p", F.coalesce(F.col("sure").cast("double"), F.lit(0.5)))
    else:
        scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found)).withColumn(
            "p", vector_to_array("probability")[1])
    best = scored.groupBy("rid", "doc_id", "candidate").agg(F.count("*").alias("occurrences"), F.max("p").alias("score"))
    return best.withColumn("is_secret", F.col("score") >= THRESHOLD)


def masked(candidate: Column) -> Column:
    """First four characters and the length; findings are reported without the secret itself."""
    return F.concat(F.substring(candidate, 1, 4), F.lit("..."), F.length(candidate).cast("string"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars",
           **how) -> DataFrame:
    """``docs`` with every confirmed secret in ``text_col`` replaced; ``chars_col``, if there, counts anew where cut."""
    secrets = scan(docs, id_col=id_col, text_col=text_col, **how).where("is_secret")
    # longest first, so that no secret is cut by one that it contains
    longest = F.expr("array_sort(collect_list(candidate), (a, b) -> case when length(a) <> length(b) "
                     "then length(b) - length(a) when a < b then -1 when a > b then 1 else 0 end)")
    rid, drop = fresh(docs, "rid"), fresh(docs, "secrets")
    lists = materialize(secrets.groupBy(F.col("rid").alias(rid)).agg(longest.alias(drop)), "secrets")
    # a secret that many documents hold is written once and takes its whole length in each row
    held = F.aggregate(drop, F.lit(NARROW_ROW).cast("long"), lambda n, s: n + F.octet_length(s))
    text = F.col(text_col)
    cleaned = F.when(F.col(drop).isNull(), text).otherwise(
        F.aggregate(drop, text, lambda t, s: F.replace(t, s, F.lit(REDACTED))))
    out = docs.withColumn(rid, F.xxhash64(F.col(id_col), text)).join(
        by_rows(lists, held), rid, "left").withColumn(text_col, cleaned)
    if chars_col in docs.columns:
        out = out.withColumn(chars_col, F.when(F.col(drop).isNull(), F.col(chars_col)).otherwise(
            F.length(text).cast(docs.schema[chars_col].dataType)))
    return out.select(*docs.columns)


@register("op5_secrets")
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id", F.sha2("candidate", 256).alias("candidate_sha256"), masked(F.col("candidate")).alias("masked"),
        "occurrences", "score", "is_secret")
