"""N-gram Jaccard join: documents whose sets of word shingles are similar, without comparing all pairs.

Method: multiple-global-order filtering. If two sets have a Jaccard similarity of at least ``t``, then under
*any* order of all tokens their prefixes of ``n - ceil(t * n) + 1`` tokens share a token. Three orders are used:

1. tokens by how often a bounded count sketch over all documents saw them, rare ones first. Its prefixes are
   shuffled by token and give the candidates, cut by size and by the position of the shared token;
2. and 3. tokens by ascending and by descending hash. Sets are stored sorted by hash, so both prefixes are
   slices of the set. A candidate must share a token in both before the sets are intersected.

Documents with equal sets are one class from the start. Each token's smallest class is its pivot: first all
classes are compared with the pivots of their tokens only, and the links found are closed into components. After
that only tokens of three or more classes are left, and of them only pairs of *different* components need a comparison; a large group of near copies never makes its pairs.
No link between different components is lost: what is skipped would join classes that are joined already.

Memory: a task holds a slice of texts or a batch of pairs. The sketch is a fixed 2**20 counters, the filter
on involved documents a fixed 2**22 bits. A hot token is combined before the shuffle (pivots) and its rows can be
split (joins); a document's exact copies emit their tokens once per task.

Results by case: null or empty text, or text of white space only: empty set, linked with nothing, a component of
its own. Repeated rows of one id: equal sets are one class; if their texts differ, each text takes part and the id
is listed once per row. Null ids: such rows take part in nothing and are left out. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from poolscope.llm.common import connected_components, give_back_memory, stored
from poolscope.llm.words import mixed, shingle_sets, text_slices

SKETCH = 1 << 20
SEGMENTS = 64
FILTER_BITS = 1 << 22
HOT, SALTS, MANY, PIVOTS = 20_000, 64, 20, 24
SCALE = 100


def overlap_needed(n_a, n_b, percent: int):
    """Smallest intersection of sets of these sizes that reaches the similarity."""
    return -((-(n_a + n_b) * percent) // (SCALE + percent))


def prefix_length(n, percent: int):
    return n + ((-n * percent) // SCALE) + 1


def _set_hash(tokens: np.ndarray) -> tuple[int, int]:
    """Two 64-bit hashes of a set; the empty set has zeros."""
    once = mixed(tokens + np.uint64(len(tokens)))
    return int(once.sum(dtype=np.uint64)), int(mixed(once).sum(dtype=np.uint64))


def _signed(values: list[tuple[int, int]]) -> np.ndarray:
    return np.array(values, dtype=np.uint64).reshape(-1, 2).view(np.int64)


_STATS = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()),
                    ("segment", pa.int32()), ("counts", pa.binary())])


def _statistics(width: int):
    """Size and hash of each text's set; after a task's last text, its part of the sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(SKETCH, dtype=np.int64)
        for batch in batches:
            for first, data, offsets in text_slices(batch.column("text")):
                sets = list(shingle_sets(data, offsets, width))
                sketch += np.bincount(_slots(np.concatenate(sets)), minlength=SKETCH)
                hashes = _signed([_set_hash(tokens) for tokens in sets])
                k = len(sets)
                yield pa.record_batch(
                    [batch.column("doc_id").slice(first, k), pa.array([len(tokens) for tokens in sets], pa.int64()),
                     pa.array(hashes[:, 0]), pa.array(hashes[:, 1]), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())],
                    schema=_STATS)
        if sketch.any():
            none = pa.nulls(SEGMENTS, pa.int64())
            yield pa.record_batch(
                [none, none, none, none, pa.array(range(SEGMENTS), pa.int32()), _segments(sketch)], schema=_STATS)
        give_back_memory()

    return run


def _slots(tokens: np.ndarray) -> np.ndarray:
    return (tokens & np.uint64(SKETCH - 1)).astype(np.int64)


def _segments(sketch: np.ndarray) -> pa.Array:
    """Counters of each segment that are not zero: their 16-bit places, then their 64-bit counts."""
    parts = []
    for part in sketch.reshape(SEGMENTS, -1):
        used = np.flatnonzero(part)
        parts.append(used.astype(np.uint16).tobytes() + part[used].tobytes())
    return pa.array(parts, pa.binary())


def _add_segment(sums: np.ndarray, counts) -> None:
    """Add the counters of one segment in place."""
    n = len(counts) // 10
    sums[np.frombuffer(counts, np.uint16, n)] += np.frombuffer(counts, np.int64, n, offset=2 * n)


def _sum_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per segment with the sum of its counts; holds the sketch and one batch."""
    sums, some = np.zeros(SKETCH, dtype=np.int64).reshape(SEGMENTS, -1), False
    for batch in batches:
        for segment, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
            _add_segment(sums[segment], counts.as_buffer())
            some = True
    if some:
        yield pa.record_batch([pa.array(range(SEGMENTS), pa.int32()), _segments(sums)], names=["segment", "counts"])


def _sketch(stats: DataFrame) -> np.ndarray:
    """The counts of all documents: a fixed number of rows reaches the driver."""
    kind = "segment int, counts binary"
    parts = stats.filter("segment IS NOT NULL").select("segment", "counts").mapInArrow(_sum_segments, kind)
    parts = parts.repartition("segment").mapInArrow(_sum_segments, kind)
    sketch = np.zeros((SEGMENTS, SKETCH // SEGMENTS), dtype=np.int64)
    for row in parts.collect():
        _add_segment(sketch[row.segment], row.counts)
    return np.minimum(sketch.ravel(), 2**31 - 1).astype(np.int32)


def _prefixes(width: int, percent: int, counts):
    """Prefix tokens of each set in order of the sketch: token, set hash, and size and position in one number.

    The number is negative for tokens that very many documents seem to have.
    """
    schema = pa.schema([("token", pa.int64()), ("class", pa.int64()), ("place", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, done = counts.value, set()
        for batch in batches:
            for _, data, offsets in text_slices(batch.column("text")):
                out: list[tuple[np.ndarray, ...]] = []
                for tokens in shingle_sets(data, offsets, width):
                    key = _set_hash(tokens) if len(tokens) else None
                    if key is None or key in done:
                        continue
                    if len(done) < 100_000:
                        done.add(key)
                    n, seen = len(tokens), sketch[_slots(tokens)]
                    first = np.argsort(seen, kind="stable")[: prefix_length(n, percent)]
                    m = len(first)
                    place = (n << 31) + np.arange(m)
                    out.append((tokens[first].view(np.int64), np.full(m, _signed([key])[0, 0]), np.where(seen[first] > HOT, -place, place)))
                if out:
                    yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*out)], schema=schema)
        give_back_memory()

    return run


def _sets(width: int, wanted):
    """Ids and sets (sorted by hash) of the documents that the filter lets through."""
    schema = pa.schema([("doc_id", pa.int64()), ("tokens", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, done = wanted.value, set()
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            kept = batch.filter(pa.array(bits[np.mod(ids, FILTER_BITS)]))
            ids = kept.column("doc_id").to_pylist()
            for first, data, offsets in text_slices(kept.column("text")):
                rows = []
                for k, tokens in enumerate(shingle_sets(data, offsets, width)):
                    key = (ids[first + k], *_set_hash(tokens))
                    if key in done:  # a repeated row
                        continue
                    if len(done) < 100_000:
                        done.add(key)
                    rows.append((ids[first + k], tokens.tobytes()))
                if rows:
                    found, sets = zip(*rows)
                    yield pa.record_batch([pa.array(found, pa.int64()), pa.array(sets, pa.binary())], schema=schema)
        give_back_memory()

    return run


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    both = np.concatenate([a, b])
    both.sort()
    return int(np.count_nonzero(both[1:] == both[:-1]))


def _verified(percent: int):
    """Pairs that pass the two hash orders and then the comparison of their whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            for k, (a, b) in enumerate(zip(batch.column("tokens_a"), batch.column("tokens_b"))):
                a, b = (np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in (a, b))
                p, q = prefix_length(len(a), percent), prefix_length(len(b), percent)
                if _shared(a[:p], b[:q]) and _shared(a[-p:], b[-q:]):
                    keep[k] = _shared(a, b) >= overlap_needed(len(a), len(b), percent)
            found = batch.filter(pa.array(keep))
            yield pa.record_batch([found.column("a"), found.column("b")], names=["a", "b"])
        give_back_memory()

    return run


def _may_reach(percent: int, n_a: str, pos_a: str, n_b: str, pos_b: str):
    """Whether sets of these sizes, sharing the tokens at these positions and none before, can be similar."""
    need = F.ceil((F.col(n_a) + F.col(n_b)) * percent / F.lit(SCALE + percent) - F.lit(1e-9))
    return F.least(F.col(n_a) - F.col(pos_a), F.col(n_b) - F.col(pos_b)) >= need


class _Join:
    """The tables of one run: documents, classes of equal sets and the tokens that several classes share."""

    def __init__(self, docs: DataFrame, width: int, percent: int, rounds: int):
        self.docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).filter("doc_id IS NOT NULL")
        self.width, self.percent, self.rounds = width, percent, rounds
        self.context = docs.sparkSession.sparkContext

    def run(self) -> DataFrame:
        kind = "doc_id long, n_shingles long, s1 long, s2 long, segment int, counts binary"
        stats = stored(self.docs.mapInArrow(_statistics(self.width), kind), "jaccard-statistics")
        sizes = stats.filter("segment IS NULL").select("doc_id", "n_shingles", "s1", "s2")
        self.repeated = not sizes.groupBy("doc_id").count().filter("count > 1").isEmpty()
        self.classes = stored(
            sizes.filter("n_shingles > 0").groupBy("s1", "s2").agg(F.min("doc_id").alias("rep")), "jaccard-classes")
        merged = self._components(self.context.broadcast(_sketch(stats)))
        named = self.classes.join(merged, F.col("rep") == F.col("node"), "left").withColumn(
            "component", F.coalesce("component", "rep"))
        return sizes.join(named.select("s1", "s2", "component"), ["s1", "s2"], "left").select(
            "doc_id", "n_shingles",
            F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"))

    def _components(self, sketch) -> DataFrame:
        """Smallest reachable id (``component``) of every class that has a link, by its smallest id (``node``)."""
        schema = "token long, class long, place long"
        prefixes = self.docs.select("text").mapInArrow(_prefixes(self.width, self.percent, sketch), schema)
        # a token that very many documents seem to have is dealt over salts, with a pivot for each
        salt = F.when(F.col("place") < 0, F.pmod("class", F.lit(SALTS))).otherwise(0).cast("int")
        of_token = Window.partitionBy("token", "salt")
        size, position = F.shiftright(F.abs("place"), 31).cast("int"), F.abs("place").bitwiseAND(F.lit(2**31 - 1)).cast("int")
        shared = (
            prefixes.withColumn("salt", salt)
            .withColumn("first", F.min(F.struct("class", "place")).over(of_token))
            .withColumn("last", F.max("class").over(of_token))
            .withColumn("rows", F.count("*").over(of_token))
            .filter("place < 0 OR first.class <> last")
            .select("token", "class", size.alias("n"), position.alias("pos"), F.col("first.class").alias("pivot"),
                    F.shiftright(F.abs("first.place"), 31).cast("int").alias("pivot_n"),
                    F.abs("first.place").bitwiseAND(F.lit(2**31 - 1)).cast("int").alias("pivot_pos"),
                    (F.col("place") < 0).alias("hot"), (F.col("rows") > 2).alias("more"))
        )
        shared = stored(shared, "jaccard-shared")
        pairs = shared.filter("class <> pivot").filter(_may_reach(self.percent, "n", "pos", "pivot_n", "pivot_pos"))
        found = self._verify(pairs.select(F.least("class", "pivot").alias("a"), F.greatest("class", "pivot").alias("b")))
        # two rows are settled by their pivot, and so are a pivot's own pairs unless its token is dealt over salts
        tokens = shared.filter("hot OR more AND class <> pivot").select("token", "class", "n", "pos").distinct()
        merged = connected_components(found, "jaccard")
        for number in range(self.rounds + 1):
            opened, rows, left = self._open(tokens, merged)
            if left == 0:
                break
            again = number < self.rounds and left > MANY * rows
            more = self._verify(self._pivot_pairs(opened, number) if again else self._all_pairs(opened))
            merged = connected_components(more.union(merged.select("node", "component")), "jaccard")
            if not again:
                break
        return merged

    def _open(self, tokens: DataFrame, merged: DataFrame) -> tuple[DataFrame, int, int]:
        """Rows of tokens that classes of different components share, their number, and how many pairs they would make."""
        labels = merged.join(self.classes, F.col("node") == F.col("rep")).select(
            F.col("s1").alias("class"), "component")
        # a class that is linked with nothing is its own component; the mark keeps its hash apart from ids
        marked = tokens.join(labels, "class", "left").withColumn(
            "component", F.when(F.col("component").isNull(), F.struct(F.lit(1).alias("k"), F.col("class").alias("id")))
            .otherwise(F.struct(F.lit(0).alias("k"), F.col("component").alias("id"))))
        several = marked.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high")
        opened = stored(marked.join(several.select("token"), "token"), "jaccard-open")
        parts = opened.groupBy("token", "component").agg(F.count("*").alias("c")).groupBy("token").agg(
            F.sum("c").alias("all"), F.sum(F.col("c") * F.col("c")).alias("own"))
        pairs = F.sum((F.col("all") * F.col("all") - F.col("own")) / 2)
        rows, left = parts.agg(F.sum("all"), pairs).first()
        return opened, rows or 0, int(left or 0)

    def _pivot_pairs(self, opened: DataFrame, number: int) -> DataFrame:
        """Every class against some others of the token it shares with most; other ones in each round.

        A shortcut only: what it does not link is compared by ``_all_pairs``.
        """
        seeds = range(number * PIVOTS, (number + 1) * PIVOTS)
        chosen = [F.min_by(F.struct("class", "n", "pos", "component"), F.xxhash64("class", F.lit(k))) for k in seeds]
        pivot = stored(opened.groupBy("token").agg(F.array(*chosen).alias("p"), F.count("*").alias("rows")), "jaccard-pivots")
        first = opened.join(pivot.select("token", "rows"), "token").groupBy("class", "n", "component").agg(
            F.max(F.struct("rows", "token", "pos")).alias("f"))
        first = first.select("class", "n", "component", F.col("f.pos").alias("pos"), F.col("f.token").alias("token"))
        pivot = pivot.select("token", F.explode("p").alias("p")).select(
            "token", F.col("p.class").alias("pc"), F.col("p.n").alias("pn"), F.col("p.pos").alias("pp"), F.col("p.component").alias("pk"))
        near = (F.col("component") != F.col("pk")) & _may_reach(self.percent, "n", "pos", "pn", "pp")
        pairs = first.join(pivot, "token").filter(near)
        return pairs.select(F.least("class", "pc").alias("a"), F.greatest("class", "pc").alias("b"))

    def _all_pairs(self, opened: DataFrame) -> DataFrame:
        """The pairs of different components that no pivot has settled."""
        left = opened.select("token", *(F.col(c).alias(f"{c}_a") for c in ("class", "n", "pos", "component")))
        right = opened.select("token", *(F.col(c).alias(f"{c}_b") for c in ("class", "n", "pos", "component")))
        near = _may_reach(self.percent, "n_a", "pos_a", "n_b", "pos_b") & F.expr(
            "class_a < class_b AND component_a <> component_b")
        return left.join(right, "token").filter(near).select(F.col("class_a").alias("a"), F.col("class_b").alias("b"))

    def _verify(self, pairs: DataFrame) -> DataFrame:
        """Links between the smallest ids of classes, of candidate pairs of set hashes."""
        reps = self.classes.select("s1", "rep")
        named = pairs.distinct().join(reps.toDF("a", "rep_a"), "a").join(reps.toDF("b", "rep_b"), "b")
        named = stored(named.select("rep_a", "rep_b"), "jaccard-named")
        bits = np.zeros(FILTER_BITS, dtype=bool)
        ids = named.select(F.col("rep_a").alias("id")).union(named.select("rep_b"))
        slots = ids.select(F.pmod("id", F.lit(FILTER_BITS)).cast("int").alias("slot")).distinct()
        bits[np.array(slots.toArrow().column(0), dtype=np.int64)] = True  # at most FILTER_BITS rows
        # sets that the filter lets through by chance meet no pair
        sets = self.docs.mapInArrow(_sets(self.width, self.context.broadcast(bits)), "doc_id long, tokens binary")
        if self.repeated:
            # rows that repeat an id and a text are one set: else each pair would be compared once for every two of its copies
            sets = sets.repartition("doc_id").dropDuplicates(["doc_id", "tokens"])
        sets = stored(sets, "jaccard-sets")
        both = named.join(sets.toDF("rep_a", "tokens_a"), "rep_a").join(sets.toDF("rep_b", "tokens_b"), "rep_b")
        both = both.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"), "tokens_a", "tokens_b")
        return both.mapInArrow(_verified(self.percent), "a long, b long")


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 75, rounds: int = 1) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` (smallest reachable id) of every row of ``docs``.

    ``width`` words make a shingle; ``percent`` is the least similarity; ``rounds`` is how often new pivots are
    tried while the pairs left far outnumber the rows that make them, before those pairs are compared one by one.
    """
    return _Join(docs, width, percent, rounds).run()
