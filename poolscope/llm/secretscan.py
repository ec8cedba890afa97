"""Secret scan: candidates by pattern, false positives removed by a random forest, in DataFrame operations only.

A candidate is a run of at least ``LEAST`` characters of tokens and encodings inside a word, or, whatever its length and
characters, a value assigned to a name with a credential word in it (quoted ones may have spaces) and the password in an
address (``user:password@host``). Candidates may overlap. A random forest (Spark's
own) judges it by length, kinds of characters and transitions between them, variety, the share of its letters that
common words of the corpus cover, whether it is part of a path or address, and the words before and after it. It is
trained on labelled findings: given ones, or, where there are none, those that ``labelled`` can label by strict
rules (an assignment to a credential's name, a known issuer's form; against plain words, numbers and addresses).

Training uses at most about ``TRAINING_ROWS`` different findings of either label, chosen by hash and weighted by how often
they occur (``MOST_WEIGHT`` at most). The common words are counted
over all documents; ``COMMON_WORDS`` of them are used. Everything else covers all rows.

Results by case: null or empty text has no findings. Repeated rows have their findings each. Without labelled
findings of both kinds the score is 1 or 0 as the strict rules say. Extra columns are ignored by ``scan`` and kept by
``redact``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poolscope.llm.common import stored

LEAST = 16
TRAINING_ROWS = 20_000
MOST_WEIGHT = 10
COMMON_WORDS = 200
#: Spans of secrets (16 bytes each and their texts' keys) that may be broadcast to redact texts.
BROADCAST_SPANS = 200_000
SPLIT = r"[\x20\x09-\x0D]+"
CANDIDATE = r"[A-Za-z0-9+/_=\-]{16,}"
CREDENTIAL = r"token|secret|passw|pwd|api.?key|access.?key|private.?key|auth|bearer|credential"
NAME = CREDENTIAL.replace("secret", "secret(?!ar)").replace("auth", "auth(?!or)")
#: The value in one word with its name; the end of a word before a value; the sign between both; a password in an address.
ASSIGNED = rf"""(?i)(?:{NAME})[^\s=:"'`]*["'`]?\]?(?::=|=>|==|=|:)(?!//)(.+)$"""
ASSIGNING = rf"""(?i)(?:{NAME})[^\s=:]*(?::=|=>|==|=|:)$"""
NAMED = rf"""(?i)(?:{NAME})[^\s=:]*$"""
SIGN = "^(:=|=>|==|=|:)$"
SIGNED = "^(?::=|=>|==|=|:)(.+)$"
#: What is before the password, and the password, in either form.
IN_ADDRESS = r"""^(.*?[A-Za-z][A-Za-z0-9+.\-]*://[^\s/:@"']*:)([^\s"']+)@[^\s@]|^(["'(<]*[A-Za-z0-9._\-]+:)([^\s:/@"']+)@[A-Za-z0-9]"""
WITH_SPACE = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"
PARTS = r"[A-Za-z0-9+/_=\-]+|[^A-Za-z0-9+/_=\-]+"
#: A value in quotes or brackets, its first word if it has spaces, and a bare value without what closes a statement.
BEFORE_BARE = r"""^["'`(\[{<]*"""
QUOTED, OPENED, BARE = r"""^(["'`])(.+?)\1""", r"""^(["'`])[^"'`]+$""", r"""^["'`(\[{<]*(.*?)["'`)\]}>,;]*$"""
ISSUED = r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_\-]{35})$"
FEATURES = ["length", "digits", "upper", "lower", "marks", "turns", "case_turns", "variety", "hex", "covered", "path",
            "credential_near", "assigned", "hash_near", "quoted"]


def text_key() -> Column:
    """A text's findings depend on the text alone, so this joins them with every row that has it, with or without an id.

    Texts that share a key share their secrets too, so each still gets all of its own.
    """
    return F.xxhash64(F.col("text").cast("string")).alias("text_key")


def candidates(docs: DataFrame) -> DataFrame:
    """One row per candidate: ``doc_id``, key of the text, number of the word, candidate, the words around it, and where it stands.

    ``start`` and ``size`` are in characters of the text.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.filter(F.split(text, SPLIT), lambda w: w != "")
    near = F.transform("_words", lambda w, i: F.struct(
        i.alias("word_no"), w.alias("word"), F.get("_words", i - 1).alias("before"), F.get("_words", i - 2).alias("before2"),
        F.get("_words", i + 1).alias("after")))
    found = F.filter(near, lambda x: (F.length(x["word"]) >= LEAST) & x["word"].rlike(CANDIDATE) | _value(x).isNotNull() | _password(x["word"]).isNotNull())
    rows = docs.select("doc_id", text_key(), text.alias("_text"), words.alias("_words"))
    rows = rows.select("doc_id", "text_key", "_text", found.alias("_found"))
    # the words before a found one are measured once, from the found word before it
    lengths = F.when(F.size("_found") > 0, F.transform(F.regexp_extract_all("_text", F.lit(WITH_SPACE), F.lit(0)), F.length))
    steps = _once(lengths, lambda n: F.transform("_found", lambda x, j: _total(F.slice(n, _last(j) + 2, x["word_no"] - _last(j)))))
    placed = _once(steps, lambda step: F.transform("_found", lambda x, j: F.struct(
        x.alias("x"), (_total(F.slice(step, 1, j + 1)) - F.length(x["word"])).alias("at"))))
    rows = rows.select("doc_id", "text_key", "_text", placed.alias("_placed"))
    spans = F.transform("_placed", lambda y: F.struct(y["x"].alias("x"), y["at"].alias("at"), _spans(y["x"], y["at"], F.col("_text")).alias("spans")))
    rows = rows.select("doc_id", "text_key", F.explode(spans).alias("y")).select("doc_id", "text_key", "y.x.*", "y.at", F.explode("y.spans").alias("s"))
    return rows.select("doc_id", "text_key", "word_no", "word", "before", "before2", "after", F.col("s.candidate").alias("candidate"),
                       (F.col("at") + F.col("s.at")).alias("start"), F.length("s.candidate").alias("size"))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value made once a row, also where lambdas refer to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0), lambda s, n: s + n)


def _last(j: Column) -> Column:
    """Number of the found word before the one at ``j``; -1 before the first."""
    return F.coalesce(F.get("_found", j - 1)["word_no"], F.lit(-1))


def _value(x: Column) -> Column:
    """What a word assigns to a credential's name, as it stands at the word's end, or null."""
    inside = F.regexp_extract(x["word"], ASSIGNED, 1)
    signed = F.regexp_extract(x["word"], SIGNED, 1)
    before, before2 = F.coalesce(x["before"], F.lit("")), F.coalesce(x["before2"], F.lit(""))
    follows = before.rlike(ASSIGNING) | before.rlike(SIGN) & before2.rlike(NAMED)
    return (F.when(x["word"].rlike(ASSIGNED), inside).when(before.rlike(NAMED) & (signed != ""), signed)
            .when(follows & ~x["word"].rlike(SIGN), x["word"]))


def _password(word: Column) -> Column:
    """The password of an address, or null."""
    at = word.contains("@") & word.contains(":")
    return F.when(at & word.rlike(IN_ADDRESS), F.concat(F.regexp_extract(word, IN_ADDRESS, 2), F.regexp_extract(word, IN_ADDRESS, 4)))


def _span(at: Column, candidate: Column) -> Column:
    return F.struct(at.cast("int").alias("at"), candidate.alias("candidate"))


def _spans(x: Column, begin: Column, text: Column) -> Column:
    """Candidates of a word (``begin`` characters into the text) and where in the word each begins."""
    word, value, password = x["word"], _value(x), _password(x["word"])
    parts = F.regexp_extract_all(word, F.lit(PARTS), F.lit(0))
    runs = _once(parts, lambda all: F.transform(all, lambda p, j: F.when(
        (F.length(p) >= LEAST) & p.rlike(CANDIDATE), _span(_total(F.transform(F.slice(all, 1, j), F.length)), p))))
    runs = F.when((F.length(word) >= LEAST) & word.rlike(CANDIDATE), runs)
    skipped = F.length(word) - F.length(value)
    plain = F.when(value.rlike(QUOTED), _span(skipped + 1, F.regexp_extract(value, QUOTED, 2))).otherwise(
        _span(skipped + F.length(F.regexp_extract(value, BEFORE_BARE, 0)), F.regexp_extract(value, BARE, 1)))
    lead = F.concat(F.regexp_extract(word, IN_ADDRESS, 1), F.regexp_extract(word, IN_ADDRESS, 3))
    # a quoted value with spaces goes on to the same quote in the same line
    rest, mark = F.substring(text, begin + skipped + 2, F.length(text)), F.substring(value, 1, 1)
    spaced = F.when(value.rlike(OPENED) & (F.length(value) > 1), F.when(mark == '"', F.regexp_extract(rest, r'^([^\n"]+)"', 1)).when(
        mark == "'", F.regexp_extract(rest, r"^([^\n']+)'", 1)).otherwise(F.regexp_extract(rest, r"^([^\n`]+)`", 1)))
    others = F.array(plain, F.when(password.isNotNull(), _span(F.length(lead), password)), F.when(spaced.isNotNull(), _span(skipped + 1, spaced)))
    both = F.concat(F.coalesce(runs, F.array().cast("array<struct<at:int,candidate:string>>")), others)
    return F.array_distinct(F.filter(both, lambda s: s.isNotNull() & s["candidate"].isNotNull() & (F.trim(s["candidate"]) != "")))


def common_words(docs: DataFrame) -> list[str]:
    """The most frequent short words of all documents, for the dictionary feature."""
    words = docs.select(F.explode(F.filter(F.split("text", SPLIT), lambda w: w.rlike("^[a-z]{3,6}$"))).alias("w"))
    top = words.groupBy("w").count().orderBy(F.desc("count"), "w").limit(COMMON_WORDS)
    return sorted((row.w for row in top.collect()), key=lambda w: (-len(w), w))


def _count(pattern: str) -> Column:
    return F.regexp_count("candidate", F.lit(pattern)).cast("double")


def featured(found: DataFrame, words: list[str]) -> DataFrame:
    """The candidates with their features."""
    length = F.length("candidate").cast("double")
    lead = F.expr(r"substring_index(word, regexp_extract(candidate, r'^(\S*)', 1), 1)")  # a candidate with spaces begins in its word
    context = F.lower(F.concat_ws(" ", "before2", "before", lead))
    covering = f"(?i){'|'.join(words)}" if words else "$^"
    columns = {
        "length": length,
        "digits": _count("[0-9]") / length,
        "upper": _count("[A-Z]") / length,
        "lower": _count("[a-z]") / length,
        "marks": _count("[^A-Za-z0-9]") / length,
        "turns": (_count("[0-9](?=[A-Za-z])") + _count("[A-Za-z](?=[0-9])")) / length,
        "case_turns": (_count("[a-z](?=[A-Z])") + _count("[A-Z](?=[a-z])")) / length,
        "variety": F.size(F.array_distinct(F.split("candidate", ""))) / F.least(length, F.lit(40.0)),
        "hex": F.col("candidate").rlike("^([0-9a-f]+|[0-9A-F]+)$").cast("double"),
        "covered": F.lit(1.0) - F.length(F.regexp_replace("candidate", covering, "")) / length,
        "path": F.col("word").rlike(r"://|^/|/[A-Za-z0-9_\-]+/|^www\.").cast("double"),
        "credential_near": context.rlike(CREDENTIAL).cast("double"),
        "assigned": F.rtrim(context).rlike(r"[=:][\"'\x20]*$").cast("double"),
        "hash_near": context.rlike(r"sha[0-9]|md5|checksum|digest|commit|uuid").cast("double"),
        "quoted": lead.rlike("[\"'`]$").cast("double"),
    }
    return found.withColumns(columns)


def labelled(rows: DataFrame) -> DataFrame:
    """``label`` 1.0 or 0.0 where strict rules decide, else null."""
    random = (F.col("variety") >= 0.2) & (F.col("digits") > 0.05) & (F.col("digits") < 1)
    given = (F.col("credential_near") == 1) & (F.col("assigned") == 1) & random & (F.col("path") == 0)
    plain = (F.col("digits") == 0) & (F.col("case_turns") < 0.1) | (F.col("digits") == 1) | (F.col("path") == 1) | (F.col("hash_near") == 1)
    in_address = F.expr("contains(word, concat(':', candidate, '@'))")
    common = (F.col("covered") == 1) & (F.col("digits") == 0)  # values of common words alone
    return rows.withColumn("label", F.when(F.col("candidate").rlike(ISSUED) | given | in_address, 1.0).when(
        plain & (F.col("credential_near") == 0) | common, 0.0))


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)


def drawn(rows: DataFrame) -> DataFrame:
    """At most about ``TRAINING_ROWS`` different labelled findings of either label, with ``weight``: how often each occurs, bounded.

    Equal findings are one row before anything is sized, so copies neither push others out nor fill the sample.
    """
    known = rows.filter("label IS NOT NULL").groupBy("label", *FEATURES).agg(F.count("*").alias("_n"))
    known = stored(known.select("label", *FEATURES, F.least("_n", F.lit(MOST_WEIGHT)).cast("double").alias("weight")), "secrets-labelled")
    sizes = {row.label: row["count"] for row in known.groupBy("label").count().collect()}
    if not sizes:
        return known
    share = F.create_map(*(x for label, n in sizes.items() for x in (F.lit(label), F.lit(min(1.0, TRAINING_ROWS / n)))))
    return known.filter(F.pmod(F.xxhash64(*FEATURES), F.lit(1_000_000)) < share[F.col("label")] * 1_000_000)


def train(rows: DataFrame, seed: int = 7) -> RandomForestClassificationModel | None:
    """A forest fitted to a bounded choice of labelled findings; None unless both labels are in it."""
    chosen = stored(drawn(rows).repartition(1).sortWithinPartitions("label", *FEATURES), "secrets-training")
    if chosen.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(numTrees=20, maxDepth=6, seed=seed, featuresCol="features", labelCol="label", weightCol="weight",
                                    cacheNodeIds=False)
    return forest.fit(_assembled(chosen))


def scan(docs: DataFrame, least_score: float = 0.5, known: DataFrame | None = None) -> DataFrame:
    """Every candidate with its score and verdict. ``known``: labelled findings with the features, if there are any."""
    words = common_words(docs)
    rows = labelled(featured(candidates(docs), words))
    rows = stored(rows, "secrets-candidates")
    model = train(known if known is not None else rows)
    if model is None:
        scored = rows.withColumn("score", F.coalesce("label", F.lit(0.0)))
    else:
        scored = model.transform(_assembled(rows)).withColumn("score", vector_to_array("probability")[1])
    return scored.withColumn("is_secret", F.col("score") >= least_score).select(
        "doc_id", "text_key", "word_no", "candidate", "start", "size", *FEATURES, "label", "score", "is_secret")


def places(findings: DataFrame) -> DataFrame:
    """``text_key`` and ``spans`` (``begin``, ``end``) of the secrets of every text that has some; overlapping ones are one."""
    each = findings.filter("is_secret").groupBy("text_key").agg(F.collect_set(F.struct(
        F.col("start").alias("begin"), (F.col("start") + F.col("size")).alias("end"))).alias("spans"))

    def merged(done: Column, s: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        wider = F.struct(last["begin"].alias("begin"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when(s["begin"] < last["end"], F.concat(F.slice(done, 1, F.size(done) - 1), F.array(wider))).otherwise(
            F.concat(done, F.array(s)))

    none = F.array().cast("array<struct<begin:int,end:int>>")
    return each.select("text_key", F.aggregate(F.array_sort("spans"), none, merged).alias("spans"))


def redact(docs: DataFrame, findings: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret replaced where it was found, and nowhere else; rows and columns stay as they are."""
    return replace_places(docs, stored(places(findings), "secrets-places"), mark)


def replace_places(docs: DataFrame, spans: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with the ``spans`` of their texts (``places``, a stored table) replaced by ``mark``.

    Spans are joined by the key of their text: rows need no id for that. Up to ``BROADCAST_SPANS`` spans are broadcast, so that
    texts stay where they are; more are joined by a shuffle.
    """
    size = spans.agg(F.sum(F.size("spans"))).first()[0] or 0
    row = F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row")
    rows = docs.select(row, F.when(F.col("text").isNotNull(), text_key()).alias("key"))
    named = spans.toDF("key", "spans")
    rows = rows.join(F.broadcast(named) if size <= BROADCAST_SPANS else named, "key", "left")
    text = F.col("row.text").cast("string")
    pieces = F.transform("spans", lambda s, j: F.concat(_between(text, _end(j), s["begin"]), F.lit(mark)))
    clean = F.concat(F.array_join(pieces, ""), _between(text, _end(F.size("spans")), F.length(text)))
    return rows.select(*(
        F.when(F.col("spans").isNull(), text).otherwise(clean).alias(name) if name == "text" else F.col("row")[name].alias(name) for name in docs.columns))


def _end(j: Column) -> Column:
    return F.coalesce(F.get("spans", j - 1)["end"], F.lit(0))


def _between(text: Column, begin: Column, end: Column) -> Column:
    return F.substring(text, begin + 1, end - begin)
