"""Secrets in texts: native candidate search, and a random forest that drops false findings.

Candidates are long runs of key characters that have a digit and a letter, or the form
of an access key id, and every run of six or more that stands behind a guard word. Their
features are length, the mix of characters, how likely their letters follow each other
and how much of them dictionary words cover (both learned from the corpus that is
scanned), path-likeness and the words beside them. The forest is trained from labelled
findings; everything runs in DataFrame expressions and Spark's own forest.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import Workspace, fresh, with_rows

#: Key characters; a long run of them, with '=' only as padding at its end.
KEY = r"[A-Za-z0-9_+/.~\-]"
END = r"(?![A-Za-z0-9_+/.~=\-])"
PADDING = f"(?:={{1,2}}{END})?"
#: It is looked for at the begin of a run only: inside one nothing else could match.
TOKEN = f"(?<!{KEY})(?:{KEY}{{16,}}{PADDING}|{KEY}{{15}}={{1,2}}{END}|{KEY}{{14}}=={END})"
#: Long runs that are candidates without a digit: access key ids.
KNOWN = "^A[KSB]IA[A-Z2-7]{16}$"
#: A maximal run of six or more key characters, with its padding: what a secret can be.
RUN = f"(?<!{KEY}){KEY}{{6,}}{PADDING}"
#: Different secrets of a text that are replaced one after the other.
FEW = 16
#: Names that stand in paths, addresses and examples.
NAMES = "path|file|name|user|data|test|http|www|com|org|html|index|image|page|config|module|class|value|example|sample|dummy|changeme|placeholder|string|number|list"
#: Words that teach the forest where the corpus has none.
SOME_WORDS = ["configuration", "international", "representation", "documentation", "environment", "relationship", "organisation", "development"]
#: A dictionary word is in so many different texts, and in this share of the documents.
LEAST_TEXTS, LEAST_SHARE = 3, 1e-6
GUARDED = "token|secret|passw|pwd|api.?key|apikey|access.?key|private.?key|auth|bearer|credential|client.?key|signing"
HARMLESS = "commit|revision|checksum|digest|md5|sha1|sha256|sha512|hash|uuid|guid|etag|version|build|href|src|url|image|integrity"
BEFORE, AFTER = 48, 24
#: A guard word with the rest of its name and what sets off the value; ahead of it (2) a run of any kind and (3) what follows.
#: Only the first part is used up, so that a run may be the guard word of the next one.
GUARDED_RUN = f"((?i:{GUARDED})[A-Za-z0-9_.\\-]{{0,12}}[\\s\"'=:>]{{1,6}})(?=({KEY}{{6,}}{PADDING})([\\s\\S]{{0,{AFTER}}}))"

FEATURES = ["size", "runs", "digits", "uppers", "lowers", "signs", "kinds", "repeats", "hex_only", "transitions", "words", "names", "slashes", "dots", "guarded", "harmless", "assigned", "quoted"]


def _is_long(token: Column) -> Column:
    return (F.length(token) >= 16) & token.rlike("[A-Za-z]") & (token.rlike("[0-9]") | token.rlike(KNOWN))


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, ordinal, token, before, after: the runs of key characters of each text and what stands beside them.

    Long runs are numbered as they stand in the text; those that are candidates only
    by the guard word before them are numbered behind all of the text's long runs.
    """
    text = F.col("text").cast("string")
    some = docs.where(text.rlike(TOKEN) | text.rlike(GUARDED_RUN))
    guard = F.arrays_zip(*(F.regexp_extract_all(text, F.lit(GUARDED_RUN), k).alias(name) for k, name in ((1, "before"), (2, "token"), (3, "after"))))
    guard = F.when(text.rlike(GUARDED_RUN), guard).otherwise(F.array().cast("array<struct<before:string,token:string,after:string>>"))
    some = some.select("doc_id", F.regexp_extract_all(text, F.lit(f"({TOKEN})"), 1).alias("tokens"), F.split(text, TOKEN).alias("gaps"), guard.alias("guard"))

    def beside(t: Column, i: Column) -> Column:
        """A long name of a key is a run itself; then the gap behind it has no guard word, and the name's end is taken."""
        gap = F.right(F.get("gaps", i), F.lit(BEFORE))
        named = F.regexp_extract(F.concat(F.right(F.get("tokens", i - 1), F.lit(BEFORE)), gap), f"(?i:{GUARDED})[A-Za-z0-9_.\\-]{{0,12}}[\\s\"'=:>]{{1,6}}$", 0)
        return F.when(gap.rlike("^[\\s\"'=:>]{1,6}$") & (i > 0), F.coalesce(F.nullif(named, F.lit("")), gap)).otherwise(gap)

    rows = F.transform(
        "tokens",
        lambda t, i: F.struct(i.alias("ordinal"), t.alias("token"), beside(t, i).alias("before"), F.left(F.get("gaps", i + 1), F.lit(AFTER)).alias("after")),
    )
    # Filtered before rows are made of them.
    rows = F.filter(rows, lambda r: _is_long(r["token"]))
    others = F.transform(
        F.filter("guard", lambda g: ~_is_long(g["token"])),
        lambda g, i: F.struct((F.size("tokens") + i).alias("ordinal"), g["token"].alias("token"), g["before"].alias("before"), g["after"].alias("after")),
    )
    return some.select("doc_id", F.explode(F.concat(rows, others)).alias("r")).select("doc_id", "r.*")


def _share(token: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(token, pattern, "")) / F.length(token)


def dictionary(docs: DataFrame, least: int = LEAST_TEXTS, share: float = LEAST_SHARE) -> DataFrame:
    """word, texts: runs of three or more letters a-z that ``least`` different texts have, and a ``share`` of all documents.

    Each document gives a word once, and copies of a text count once, so that what a passage repeats is no word.
    """
    low = F.lower(F.col("text").cast("string"))
    words = F.filter(F.array_distinct(F.split(low, "[^a-z]+")), lambda w: F.length(w) >= 3)
    each = docs.where(F.col("text").isNotNull()).select(F.xxhash64(F.col("text").cast("string")).alias("h"), F.explode(words).alias("word"))
    bound = max(least, math.ceil(share * docs.count()))
    return each.groupBy("word").agg(F.approx_count_distinct("h", 0.1).alias("texts")).where(F.col("texts") >= bound)


def transitions(words: DataFrame) -> list[float]:
    """Log probability of a letter after another, 26 x 26, in the dictionary's words; smoothed by one of each."""
    pair = lambda i: F.substring("word", i, F.lit(2))
    pairs = words.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), pair)).alias("pair"))
    counts = {r["pair"]: r["n"] for r in pairs.groupBy("pair").agg(F.count("*").alias("n")).collect()}  # at most 676 lines
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [[counts.get(a + b, 0) + 1 for b in letters] for a in letters]
    return [math.log(n / sum(row)) for row in rows for n in row]


def _coverage(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with words: the share of each token that runs of letters in the dictionary cover.

    Different tokens and different runs are joined, so that one that half the corpus has is one row.
    """
    tokens = found.select("token").distinct()
    runs = tokens.select("token", F.explode(F.regexp_extract_all("token", F.lit("[A-Z]?[a-z]{2,}|[A-Z]{3,}"), 0)).alias("run")).withColumn("run", F.lower("run"))
    known = runs.select("run").distinct().join(words.select(F.col("word").alias("run")), "run", "left_semi")
    covered = runs.join(known, "run").groupBy("token").agg(F.sum(F.length("run")).alias("covered"))
    return found.join(covered, "token", "left").withColumn("words", F.coalesce(F.col("covered"), F.lit(0)) / F.length("token")).drop("covered")


def features(found: DataFrame, words: DataFrame, likely: list[float]) -> DataFrame:
    """``found`` (token, before, after) with the columns in FEATURES."""
    t, low = F.col("token"), F.lower("token")
    near = F.lower(F.coalesce("before", F.lit("")))

    def share(token: Column, pattern: str) -> Column:
        return F.length(F.regexp_replace(token, pattern, "")) / F.length(token)

    # Mean over neighbours that are both letters; a token without any has none that is likely.
    logs = F.array(*(F.lit(x) for x in likely))
    codes = F.transform(F.split(low, ""), lambda c: F.ascii(c) - 97)
    inside = lambda c: (c >= 0) & (c < 26)
    n = F.greatest(F.size(codes) - 1, F.lit(0))
    steps = F.zip_with(F.slice(codes, F.lit(1), n), F.slice(codes, F.lit(2), n), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    steps = F.filter(steps, lambda s: inside(s["a"]) & inside(s["b"]))
    total = F.aggregate(steps, F.lit(0.0), lambda s, x: s + F.element_at(logs, x["a"] * 26 + x["b"] + 1))
    return _coverage(found, words).select(
        *found.columns,
        F.length(t).cast("double").alias("size"),
        (F.length(F.regexp_replace(t, "[a-z]+|[A-Z]+|[0-9]+|[^a-zA-Z0-9]+", "x")) / F.length(t)).alias("runs"),
        share(t, "[^0-9]").alias("digits"),
        share(t, "[^A-Z]").alias("uppers"),
        share(t, "[^a-z]").alias("lowers"),
        share(t, "[A-Za-z0-9]").alias("signs"),
        (F.size(F.array_distinct(F.split(t, ""))) / F.length(t)).alias("kinds"),
        (1 - share(t, r"(.)\1{3,}")).alias("repeats"),
        low.rlike("^[0-9a-f]+$").cast("double").alias("hex_only"),
        F.coalesce(F.try_divide(total, F.size(steps)), F.lit(-5.0)).alias("transitions"),
        "words",
        (1 - share(low, NAMES)).alias("names"),
        share(t, "[^/]").alias("slashes"),
        share(t, "[^.]").alias("dots"),
        near.rlike(f"({GUARDED})[^\\s]{{0,12}}[\\s\"'=:>]{{0,6}}$").cast("double").alias("guarded"),
        near.rlike(f"({HARMLESS})[^\\s]{{0,12}}[\\s\"'=:/>]{{0,6}}$").cast("double").alias("harmless"),
        near.rlike("[=:]\\s*[\"']?$").cast("double").alias("assigned"),
        (near.rlike("[\"']$") & F.coalesce("after", F.lit("")).rlike("^[\"']")).cast("double").alias("quoted"),
    )


def labelled_findings(spark: SparkSession, words: list[str], held_out: bool = False, each: int = 240) -> DataFrame:
    """Labelled findings: token, before, after, label. Made by rule from hashes and ``words``, ``each`` of every shape.

    The ``held_out`` ones have other shapes: other guard words, other settings, other kinds of tokens.
    """
    words = words or SOME_WORDS
    base = spark.range(each, numPartitions=1)
    n = F.col("id").cast("string")
    part = "held" if held_out else ""
    h1, h2 = F.sha1(F.concat(F.lit("a" + part), n)), F.sha2(F.concat(F.lit("b" + part), n), 256)
    b64 = F.base64(F.unhex(h2))
    plain = F.regexp_replace(b64, "[^A-Za-z0-9]", "k")
    letters, caps = F.translate(h2, "0123456789", "ghijklmnop"), F.upper(F.translate(h2, "0123456789", "qrstuvwxyz"))

    def pick(k, *some):
        return F.element_at(F.array(*(F.lit(w) for w in some)), (F.pmod(F.xxhash64(F.lit(f"{k}{part}"), "id"), F.lit(len(some))) + 1).cast("int"))

    def word(k):
        return pick(k, *words)

    def common(k):
        return pick(k, "correct", "horse", "battery", "staple", "river", "purple", "garden", "monkey", "dragon", "winter", "coffee", "rocket")

    uuid = F.concat_ws("-", F.substring(h1, 1, 8), F.substring(h1, 9, 4), F.substring(h1, 13, 4), F.substring(h1, 17, 4), F.substring(h1, 21, 12))
    usual = pick("u", "required", "optional", "string", "number", "placeholder", "changeme", "example", "password", "default", "disabled", "function", "authentication", "manager", "between", "another", "written", "nothing", "because", "should", "management")
    name = F.concat(pick("m", "request", "config", "os", "self", "settings", "params"), F.lit("."), pick("f", "headers", "environ", "password", "get_token", "auth_key", "value"))
    number = F.substring(F.conv(F.substring(h1, 1, 6), 16, 10), 1, 3)
    secret = [
        (h1, "api_key: ", "\n"), (F.substring(h2, 1, 32), "secret=", " "), (h2, "password: '", "'"), (b64, 'client_secret = "', '"'), (b64, "Authorization: Bearer ", "\n"), (h1, 'access_key = "', '"'), (h1, "bearer: ", " | "), (F.upper(h1), 'API_KEY="', '"'), (F.upper(h1), 'secret = "', '" '), (h1, 'apikey = "', '"; '),
        (F.concat(F.lit("AKIA"), F.upper(F.substring(h1, 1, 16))), "aws_access_key_id = ", "\n"), (F.concat(F.lit("AKIA"), F.substring(caps, 1, 16)), "aws_access_key_id = ", "\n"), (F.concat(F.lit("AKIA"), F.substring(caps, 1, 16)), "id ", " "), (F.concat(F.lit("AKIA"), F.upper(F.substring(h1, 1, 16))), "id ", " "), (F.concat(F.lit("ghp_"), F.substring(plain, 1, 36)), "auth ", " "), (F.concat(F.lit("sk_live_"), F.substring(plain, 2, 24)), 'credential: "', '"'),
        (F.substring(plain, 1, 24), "passwd=", ";"), (F.substring(plain, 1, 8), "password: '", "'"), (F.substring(plain, 1, 12), "passwd=", "\n"), (F.substring(plain, 3, 10), 'passwd = "', '"'), (F.substring(h1, 1, 12), "secret=", "\n"), (F.substring(plain, 1, 14), "password: ", "\n"), (F.substring(h1, 3, 14), 'api_key="', '"'),
        (F.concat(common(1), number), "password=", " "), (F.concat(common(2), number, F.lit("x")), "password: '", "'"), (F.concat_ws("-", common(3), common(4), common(5), common(6)), 'password = "', '"'), (F.concat(common(7), common(8), common(9)), "password=", "\n"), (F.concat_ws("-", common(3), common(5), common(7)), "secret: ", "\n"),
        (F.substring(letters, 1, 32), 'secret = "', '"'), (F.substring(letters, 1, 24), "secret=", "\n"), (F.substring(letters, 1, 16), "password: ", "\n"), (F.regexp_replace(F.substring(plain, 1, 20), "[0-9]", "Q"), "api_key: ", "\n"),
    ]
    harmless = [
        (h1, "commit ", "\n"), (h2, "sha256:", " "), (F.md5(n), "md5 checksum: ", "\n"), (h1, "etag: ", "\n"), (F.md5(h1), "revision = ", "\n"), (uuid, "uuid: ", " "), (uuid, 'guid="', '"'),
        (F.concat(F.lit("usr/local/lib/"), word("a"), F.lit("/module"), n, F.lit(".html")), "/", " "), (F.concat(word("b"), F.lit("-"), word("c"), n), "the ", " and "), (F.concat(F.lit("img/"), n, F.lit("/"), word("d"), F.lit("_page.png")), 'src="', '"'), (F.concat(word("e"), n, word("f")), "of ", "."), (F.concat(F.lit("www."), word("g"), n, F.lit(".example.com")), "http://", "/ "), (F.concat(word("h"), F.lit("..."), word("i"), n), "", " "), (F.concat(F.lit("mail"), n, F.lit(".example.com.test")), "user@", " "), (F.concat(word("j"), F.lit("_"), word("k"), F.lit("_"), word("l"), number), "see ", " "),
        (F.concat(F.lit("xxxxxxxxxxxxxxxxxxxx"), n), 'secret = "', '"'), (F.concat(F.lit("example-placeholder-"), n), "api_key: ", "\n"), (F.concat(n, F.lit("-2024-01-01T00.00.00Z")), "version ", " "), (F.concat(F.lit("_____________________v"), n), "\n", "\n"), (F.concat(F.lit("0000000000000000"), n, F.lit("a")), "api_key=", " "),
        (word("m"), "the author ", " and "), (usual, "the secret ", " is "), (usual, "the password ", " "), (usual, "password: ", "\n"), (usual, "password=", " "), (usual, 'api_key = "', '"'), (word("n"), "authentication: ", "\n"), (name, "secret = ", "\n"), (name, "password=", ","), (F.lit("Bearer"), "Authorization: ", " "), (F.concat(F.lit("your-"), pick("y", "token", "password", "secret", "key"), F.lit("-here")), "secret=", " "), (F.initcap(word("o")), "Author: ", "\n"), (common(1), "secret ", " "), (F.concat(usual, F.lit(".")), "authority ", "\n"), (word("p"), "password ", ", "), (F.concat(word("q"), F.lit("-"), word("r")), "secret ", " "), (F.concat(F.lit("your-"), usual), 'password = "', '"'), (F.lpad(n, 6, "1"), "max_auth=", " "),
    ]
    if held_out:
        secret = [
            (h1, 'token = "', '" '), (F.upper(h1), 'TOKEN = "', '"!! '), (F.substring(plain, 1, 40), "auth_token: ", "\n"), (b64, "signing_key='", "'"), (F.substring(h2, 1, 48), "X-Api-Key: ", "\n"), (F.substring(h1, 1, 20), "PRIVATE_KEY=", "\n"), (F.concat(F.lit("glpat-"), F.substring(plain, 1, 20)), "access_key: ", "\n"), (F.concat(F.lit("ASIA"), F.substring(caps, 3, 16)), "key ", " "),
            (F.substring(plain, 5, 9), "pwd: ", "\n"), (F.substring(h1, 2, 10), 'pwd="', '"'), (F.concat(common(1), F.lit("_"), number), "pwd=", "&"), (F.concat_ws(".", common(2), common(3), common(4)), 'passwd: "', '"'), (F.substring(letters, 5, 28), "client_key=", "\n"),
        ]
        harmless = [
            (F.md5(h2), "digest ", " "), (h1, "tree/", "/"), (h2, "integrity=sha256-", '"'), (uuid, "request id: ", "\n"), (F.concat(F.lit("static/"), word("a"), F.lit("/"), word("b"), number, F.lit(".js")), "href=/", " "), (F.concat(word("c"), F.lit("_"), number, F.lit("_"), word("d")), "in ", " "), (F.concat(F.lit("build-2023.11."), n, F.lit("-release")), "tag ", "\n"),
            (usual, "token: ", "\n"), (usual, "your pwd ", " "), (name, "pwd = ", "\n"), (word("e"), "the token ", " was "), (F.concat(word("f"), F.lit("-"), word("g")), "authors: ", "\n"), (F.concat(F.lit("--------------------"), n, F.lit("a")), "\n", "\n"),
        ]
    out = None
    for label, shapes in ((1.0, secret), (0.0, harmless)):
        for token, before, after in shapes:
            one = base.select(token.alias("token"), F.lit(before).alias("before"), F.lit(after).alias("after"), F.lit(label).alias("label"))
            out = one if out is None else out.unionByName(one)
    return out


def _stitched(mask: str) -> Column:
    """A text from its runs and the gaps around them, where the runs numbered in ``at`` (sorted) are ``mask``."""
    # Stretches between masked runs are joined whole, so that the work grows with the runs, not with runs times secrets.
    ends = F.concat(F.array(F.lit(-1)), F.col("at"), F.array(F.size("runs")))
    stretch = lambda a, b: F.array_join(F.concat(F.array(F.get("gaps", a + 1)), F.flatten(F.zip_with(F.slice("runs", a + 2, b - a - 1), F.slice("gaps", a + 3, b - a - 1), lambda r, g: F.array(r, g)))), "")
    n = F.size(ends) - 1
    return F.array_join(F.zip_with(F.slice(ends, F.lit(1), n), F.slice(ends, F.lit(2), n), stretch), mask)


@dataclass
class Detector:
    """A forest and what its features need: the dictionary as a written table, and the 676 letter transitions."""

    forest: PipelineModel
    words: DataFrame
    likely: list[float]

    def judge(self, found: DataFrame) -> DataFrame:
        """``found`` (token, before, after) with size and the probability of a secret."""
        out = self.forest.transform(features(found, self.words, self.likely))
        return out.select(*found.columns, F.col("size").cast("long").alias("size"), vector_to_array("probability")[1].alias("probability"))


def fit(docs: DataFrame, findings: DataFrame | None = None, trees: int = 24, depth: int = 8, seed: int = 7, sample: int = 240) -> Detector:
    """A detector for ``docs`` (text): dictionary and transitions from all of them, the forest from labelled findings.

    ``findings`` are token, before, after, label (0 or 1); without them they are made by rule, harmless ones with at
    most ``sample`` dictionary words. The forest is trained in one task on what is given.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "secrets")
    words = ws.table(dictionary(docs), "dictionary")
    likely = transitions(words)
    if findings is None:
        chosen = words.where(F.length("word") >= 6).orderBy(F.xxhash64("word")).limit(sample).collect()
        findings = labelled_findings(spark, sorted(SOME_WORDS + [r["word"] for r in chosen]))
        words = ws.table(words.select("word").unionByName(spark.createDataFrame([(w,) for w in SOME_WORDS], "word string")).distinct(), "words")
    findings = ws.table(findings.coalesce(1), "findings")
    forest = RandomForestClassifier(labelCol="label", featuresCol="x", numTrees=trees, maxDepth=depth, seed=seed, subsamplingRate=0.8)
    rows = ws.table(features(findings, words, likely).select(*FEATURES, "label").coalesce(1).sortWithinPartitions(*FEATURES, "label"), "features")
    return Detector(Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="x"), forest]).fit(rows), words, likely)


def _verdicts(docs: DataFrame, detector: Detector, threshold: float) -> DataFrame:
    """Candidates of ``docs`` (doc_id, text), written once, with probability and is_secret."""
    found = Workspace(docs.sparkSession, "findings").table(candidates(docs), "candidates")
    return detector.judge(found).withColumn("is_secret", F.col("probability") >= threshold)


def scan(docs: DataFrame, detector: Detector, threshold: float = 0.5) -> DataFrame:
    """Candidate findings of ``docs`` (doc_id, text; more columns are ignored) with the forest's verdict.

    Returns doc_id, ordinal (of the run in its text), token_sha256, size, probability,
    is_secret, and token. Null and empty texts, and texts without a long run of key
    characters that has a letter and a digit, or a shorter or digit-free one behind a
    guard word, give no row; repeated rows give repeated findings, also those without
    a doc_id; an empty table gives an empty result.
    """
    found = _verdicts(docs.select("doc_id", "text"), detector, threshold)
    return found.select("doc_id", "ordinal", F.sha2("token", 256).alias("token_sha256"), "size", "probability", "is_secret", "token")


def redact(docs: DataFrame, detector: Detector, threshold: float = 0.5, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with each secret found in a text replaced by ``mask``; all rows and columns stay.

    Rows of null or repeated doc_id are masked each by its own findings. In a text with more than ``FEW`` different
    secrets each run of key characters is looked up, instead of each secret in the text.
    """
    row = fresh(docs, "_number")
    ws = Workspace(docs.sparkSession, "redact")
    numbered, _ = with_rows(ws, docs, "doc_id", row)
    found = _verdicts(numbered.select(F.col(row).alias("doc_id"), "text"), detector, threshold)
    hidden = fresh(docs, "_secrets")
    found = ws.table(found.where("is_secret").groupBy(F.col("doc_id").alias(row)).agg(F.collect_set("token").alias(hidden)), "secrets")
    # Longer ones first, so that one that is part of another does not break it.
    ordered = F.transform(F.array_sort(F.transform(hidden, lambda t: F.struct((-F.length(t)).alias("n"), t.alias("t")))), lambda s: s["t"])
    # A short one may be part of ordinary words; it is replaced where it stands alone.
    alone = lambda t: F.concat(F.lit(f"(?<!{KEY})\\Q"), t, F.lit(f"\\E(?!{KEY})"))
    quoted = mask.replace("\\", "\\\\").replace("$", "\\$")
    masked = F.aggregate(ordered, F.col("text").cast("string"), lambda s, t: F.when(_is_long(t), F.replace(s, t, F.lit(mask))).otherwise(F.regexp_replace(s, alone(t), F.lit(quoted))))
    few = found.where(F.size(hidden) <= FEW)
    joined = numbered.join(few, row, "left").withColumn("text", F.when(F.col(hidden).isNull(), F.col("text")).otherwise(masked))
    many = found.where(F.size(hidden) > FEW)
    if many.isEmpty():
        return joined.select(*docs.columns)
    # Runs are numbered in their text, joined with its secrets, and their marks come back to it in order.
    texts = numbered.join(many.select(row), row, "left_semi").select(F.col(row).alias("row"), F.col("text").cast("string").alias("text"))
    texts = texts.select("row", F.regexp_extract_all("text", F.lit(f"({RUN})"), 1).alias("runs"), F.split("text", RUN, -1).alias("gaps"))
    runs = texts.select("row", F.posexplode("runs").alias("at", "run"))
    marks = runs.join(many.select(F.col(row).alias("row"), F.explode(hidden).alias("run")).distinct(), ["row", "run"], "left_semi")
    marks = marks.groupBy("row").agg(F.array_sort(F.collect_list("at")).alias("at"))
    cut = ws.table(texts.join(marks, "row").select("row", _stitched(mask).alias("masked")), "masked")
    out = joined.join(cut.withColumnsRenamed({"row": row, "masked": hidden + "_"}), row, "left").withColumn("text", F.coalesce(hidden + "_", "text"))
    return out.select(*docs.columns)
