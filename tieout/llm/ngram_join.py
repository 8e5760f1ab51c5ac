"""Near duplicates: all pairs of shingle sets with a Jaccard similarity of 0.75 or more.

Token-combination prefixes. A token is a shingle; tokens fall into classes by hash,
classes are counted over all documents, and tokens are ordered by the count of
their class. Linked sets share a token among the first n - ceil(t n) + 1 of each,
and l tokens among the first n - ceil(t n) + l.

- A token of a rare class in the prefix is a signature by itself. The count of its
  class bounds its list, whatever the data, to a small part of an average task.
- A set whose prefix reaches frequent classes extends it by l = g + 1 and splits the
  frequent tokens there into g groups: two of the l shared ones fall into one group,
  so pairs of tokens within a group are signatures (k = 2). g is about a tenth of the
  size, by steps of the size that linked sets cannot skip, so there are about as many
  pairs as tokens.

One of these has to be common to both, so every link is a candidate. A signature also
says how much of a set is left from its place on: sets that first agree there cannot
share more, and candidates that this rules out are never paired. Documents that have
a passage in common and differ otherwise mostly fall to that.

Equal sets are one node from the start: a task signs a set once, and what signatures
move is a key of the set, not the document. Candidates are then verified on the whole
texts, first against one leader per signature, then, only where a signature still
spans several components, among the rest: no group is expanded into all its pairs.

The result is components and not links: candidates already in one component are
neither verified nor counted.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, forget, shuffles_deleted
from .common import STEP_2, Words, bounded, by_batch, mix, sequences, texts_of
from .graph import components

SHINGLE = 5
#: Linked if 100 * shared >= PERCENT * union. The prefixes below assume 75.
PERCENT = 75
CLASSES = 1 << 20
#: Class counts travel as arrays of this many.
CHUNK = 1 << 12
BITS = 1 << 12
#: 64-bit columns that the join of what is left folds the parities to.
JOIN_COLUMNS = 16
#: Single tokens meet by hash in so many parts, one after the other: only a part of them is in a shuffle at once.
PARTS = 2
#: Set keys that a task remembers to sign each set once; all are forgotten when there are more.
REMEMBERED = 1_000_000


def shingle_sets(column: pa.Array, words: Words) -> list[np.ndarray]:
    """The set of each text, sorted: 5-word shingles, or the whole of a shorter sequence."""
    h, bounds = words(column)
    runs = sequences(h, SHINGLE)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        n = b - a
        if n >= SHINGLE:
            s = np.sort(runs[a : b - SHINGLE + 1])
            out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        else:
            out.append(mix(sequences(h[a:b], n) + np.full(1, n, np.uint64) * STEP_2) if n else h[:0])
    return out


EMPTY = np.empty(0, np.uint64)


def class_of(tokens: np.ndarray) -> np.ndarray:
    return (tokens & np.uint64(CLASSES - 1)).astype(np.int64)


def parity_bits(s: np.ndarray) -> np.ndarray:
    """BITS parities of a set, as 64-bit numbers: a token that only one set has turns one bit."""
    odd = np.bincount((s >> np.uint64(64 - 12)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def first_pass(docs: DataFrame) -> DataFrame:
    """Rows of documents (doc_id, n, set_key) and, per task, rows of class counts (chunk, amounts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, amounts = Words(lower=True), np.zeros(CLASSES, np.int64)
        names = ["doc_id", "n", "set_key", "chunk", "amounts"]
        for whole in batches:
            for batch in bounded(whole):
                sets = shingle_sets(batch.column("text"), words)
                keys = [digest_of(s) for s in sets]
                np.add.at(amounts, class_of(np.concatenate([EMPTY, *sets])), 1)
                ids = batch.column("doc_id")
                gaps = pa.nulls(len(ids), pa.int32()), pa.nulls(len(ids), pa.binary())
                sizes = pa.array(map(len, sets), pa.int64())
                yield pa.RecordBatch.from_arrays([ids, sizes, pa.array(keys, pa.binary()), *gaps], names)
        if amounts.any():
            chunks = [x.tobytes() for x in amounts.reshape(-1, CHUNK)]
            gaps = [pa.nulls(len(chunks), t) for t in (pa.int64(), pa.int64(), pa.binary())]
            yield pa.RecordBatch.from_arrays([*gaps, pa.array(range(len(chunks)), pa.int32()), pa.array(chunks, pa.binary())], names)

    schema = "doc_id long, n long, set_key binary, chunk int, amounts binary"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def summed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The sums of ``amounts`` per key, held one at a time as sorted rows come in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None

        def out() -> pa.RecordBatch:
            values = [pa.array([k], pa.int32()) for k in at]
            return pa.RecordBatch.from_arrays([*values, pa.array([total.tobytes()], pa.binary())], [*keys, "amounts"])

        for batch in batches:
            for *key, raw in zip(*(batch.column(c).to_pylist() for c in (*keys, "amounts"))):
                if key != at:
                    if total is not None:
                        yield out()
                    at, total = key, np.zeros(CHUNK, np.int64)
                total += np.frombuffer(raw, np.int64)
        if total is not None:
            yield out()

    schema = ", ".join(f"{k} int" for k in keys) + ", amounts binary"
    return rows.select(*keys, "amounts").repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def class_counts(counted: DataFrame) -> np.ndarray:
    """How many tokens each class has: a table of fixed size, whatever the corpus."""
    rows = counted.filter("chunk is not null").withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(64)))
    out = np.zeros(CLASSES, np.int64)
    with shuffles_deleted(counted.sparkSession):
        sums = summed(summed(rows, ["chunk", "salt"]), ["chunk"]).collect()
    for r in sums:
        out[r["chunk"] * CHUNK : (r["chunk"] + 1) * CHUNK] = np.frombuffer(r["amounts"], np.int64)
    return out


#: Signatures, and for each what is left of the set.
Signed = tuple[np.ndarray, np.ndarray]
NONE: Signed = (EMPTY, np.empty(0, np.int64))


class Signer:
    """Signatures of a set, given the counts of the classes."""

    def __init__(self, amounts: np.ndarray):
        self.amounts = amounts
        mean = amounts.mean()
        #: A class is rare up to what chance gives an average class.
        self.rare_up_to = mean + 8 * np.sqrt(mean) + 32
        self.steps = (4 / 3) ** np.arange(1, 120)

    def __call__(self, s: np.ndarray) -> tuple[Signed, Signed]:
        """(single tokens, token pairs), each with what two sets that first agree there can share at most."""
        n = len(s)
        if not n:
            return NONE, NONE
        count = self.amounts[class_of(s)]
        order = np.argsort(count, kind="stable")  # the set is sorted: ties go by token
        s, count = s[order], count[order]
        prefix = n // 4 + 1  # n - ceil(0.75 n) + 1
        rare = int(np.searchsorted(count, self.rare_up_to, side="right"))
        alone = min(prefix, rare)
        singles = s[:alone], n - np.arange(alone)
        if rare >= prefix:
            return singles, NONE
        step = int(np.searchsorted(self.steps, n, side="right"))
        made = [self.pairs(s, rare, prefix, j) for j in (step, step - 1) if j >= 0]
        return singles, tuple(np.concatenate(x) for x in zip(*made))

    def pairs(self, s: np.ndarray, rare: int, prefix: int, step: int) -> Signed:
        groups = max(1, int(0.1 * (4 / 3) ** step))
        tokens = s[rare : prefix + groups]
        of, place = (mix(tokens) % np.uint64(groups)).astype(np.int64), rare + np.arange(len(tokens))
        order = np.lexsort((tokens, of))
        tokens, of, place = tokens[order], of[order], place[order]
        made, left, gap = [EMPTY], [place[:0]], 1
        while gap < len(tokens):
            same = of[gap:] == of[:-gap]
            if not same.any():
                break
            made.append(mix(mix(tokens[:-gap][same] * STEP_2 + tokens[gap:][same]) + np.uint64(step + 1)))
            # of the first groups + 1 common tokens, at most that many lie before the later one of the pair
            left.append(len(s) - np.maximum(place[:-gap], place[gap:])[same] + groups)
            gap += 1
        sig, left = np.concatenate(made), np.concatenate(left)
        order = np.lexsort((-left, sig))
        sig, left = sig[order], left[order]
        first = np.concatenate(([True], sig[1:] != sig[:-1])) if len(sig) else np.empty(0, bool)
        return sig[first], left[first]


def short_key(digest: bytes | None) -> int | None:
    """The first 60 bits of a set's digest. Sets that share them by chance become candidates, nothing more."""
    return int.from_bytes(digest[:8], "big") >> 4 if digest else None


def digest_of(s: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None


def signatures(docs: DataFrame, amounts: np.ndarray) -> DataFrame:
    """(key, n, bits, singles, pairs) of every set, once per task: key, size, parities and signatures.

    A pair is (sig, fit). A single token is its number only: what is left of the set
    from there on is the size less its place in the list.
    """
    shared = docs.sparkSession.sparkContext.broadcast(amounts)  # CLASSES numbers

    def lists(arrays: list[np.ndarray]) -> pa.Array:
        ends = np.cumsum([0, *map(len, arrays)])
        values = np.concatenate(arrays) if arrays else EMPTY
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.view(np.int64)))

    def signed(sets: list[np.ndarray], made: list[Signed]) -> pa.Array:
        sig = lists([a for a, _ in made])
        # size and rest in one number
        fit = np.concatenate([NONE[1], *[(len(s) << 32) + b for s, (_, b) in zip(sets, made)]])
        return pa.ListArray.from_arrays(sig.offsets, pa.StructArray.from_arrays([sig.values, pa.array(fit, pa.int64())], ["sig", "fit"]))

    def work(batch: pa.RecordBatch, own: tuple[Words, Signer, set[int]]) -> pa.RecordBatch:
        words, signer, known = own
        if len(known) > REMEMBERED:
            known.clear()
        sets, keys = [], []
        for s in shingle_sets(batch.column("text"), words):
            key = short_key(digest_of(s))
            if key is not None and key not in known:
                known.add(key)
                sets.append(s)
                keys.append(key)
        made = [signer(s) for s in sets]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(keys, pa.int64()), pa.array(map(len, sets), pa.int64()), lists([parity_bits(s) for s in sets]),
                lists([a for (a, _), _ in made]), signed(sets, [b for _, b in made]),
            ],
            ["key", "n", "bits", "singles", "pairs"],
        )

    return by_batch(
        docs.select("doc_id", "text"), work,
        "key long, n long, bits array<long>, singles array<long>, pairs array<struct<sig: long, fit: long>>",
        lambda: (Words(lower=True), Signer(shared.value), set()),
    )


def marks_of() -> list[Column]:
    """Sizes and parities (n, p0, p1, ...), the latter as plain columns, which joins compile."""
    return [F.col("n"), *[F.col("bits")[i].alias(f"p{i}") for i in range(BITS // 64)]]


def folded(marks: DataFrame, columns: int) -> DataFrame:
    """``marks`` without sizes and with fewer, coarser parities: the sums of several are parities too."""
    sums = [[F.col(f"p{i}") for i in range(j, BITS // 64, columns)] for j in range(columns)]
    return marks.select("node", *[reduce(Column.bitwiseXOR, x).alias(f"p{j}") for j, x in enumerate(sums)])


def may_link(n: str, rest: str, other_n: str, other_rest: str) -> Column:
    """Whether two sets that first agree at a signature can share as much as a link takes."""
    return (100 + PERCENT) * F.least(rest, other_rest) >= PERCENT * (F.col(n) + F.col(other_n))


def shared_at_most(na: Column, nb: Column, a: str, b: str, columns: int = BITS // 64) -> Column:
    """A bound of what two sets share. Sets that differ in d tokens differ in at most d parities."""
    differ = reduce(Column.__add__, [F.bit_count(F.col(f"{a}p{i}").bitwiseXOR(F.col(f"{b}p{i}"))) for i in range(columns)])
    return F.least(na, nb, F.floor((na + nb - differ) / 2)).cast("long")


def bounded_pairs(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """(a, b, total, most): the sizes of both sets and a bound of what they share."""
    side = lambda c: marks.select(F.col("node").alias(c), *[F.col(x).alias(c + x) for x in marks.columns[1:]])
    both = pairs.join(side("b"), "b").join(side("a"), "a")
    most = shared_at_most(F.col("an"), F.col("bn"), "a", "b")
    return both.select("a", "b", (F.col("an") + F.col("bn")).alias("total"), most.alias("most"))


def fits(n: np.ndarray, rest: np.ndarray, other_n: np.ndarray, other_rest: np.ndarray) -> np.ndarray:
    """``may_link`` and like sizes, for arrays."""
    enough = (100 + PERCENT) * np.minimum(rest, other_rest) >= PERCENT * (n + other_n)
    return enough & (100 * np.minimum(n, other_n) >= PERCENT * np.maximum(n, other_n))


def with_partner(sig: np.ndarray, n: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Which rows may be linked to another row of their signature; rows come by signature.

    A class is rare up to a bound, so the lists that are compared here are short.
    """
    out = np.zeros(len(sig), bool)
    at, gap = np.arange(len(sig)), 1
    while True:
        at = at[at + gap < len(sig)]
        at = at[sig[at] == sig[at + gap]]
        if not len(at):
            return out
        open_ = at[~(out[at] & out[at + gap])]
        good = open_[fits(n[open_], rest[open_], n[open_ + gap], rest[open_ + gap])]
        out[good] = out[good + gap] = True
        gap += 1


def meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(sig, fit, key) of the rows that may be linked to another one of their signature, from rows sorted by (sig, key)."""
    names = ["sig", "fit", "key"]
    rest = {c: np.empty(0, np.int64) for c in names}

    def found(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
        keep = with_partner(rows["sig"], rows["fit"] >> 32, rows["fit"] & 0xFFFFFFFF)
        return pa.RecordBatch.from_arrays([pa.array(rows[c][keep], pa.int64()) for c in names], names)

    for batch in batches:
        rows = {c: np.concatenate((rest[c], batch.column(c).to_numpy())) for c in names}
        sig, key = rows["sig"], rows["key"]
        new = np.concatenate(([True], (sig[1:] != sig[:-1]) | (key[1:] != key[:-1]))) if len(sig) else np.empty(0, bool)
        rows = {c: x[new] for c, x in rows.items()}  # a set that several tasks signed
        sig = rows["sig"]
        if not len(sig):
            continue
        # the last signature may go on in the next batch
        cut = int(np.searchsorted(sig, sig[-1], side="left"))
        rest = {c: x[cut:] for c, x in rows.items()}
        if cut:
            yield found({c: x[:cut] for c, x in rows.items()})
    if len(rest["sig"]):
        yield found(rest)


def meeting(single: DataFrame) -> DataFrame:
    """The rows (sig, fit, key) that may be linked to another one of their signature."""
    return single.repartition("sig").sortWithinPartitions("sig", "key").mapInArrow(meetings, "sig long, fit long, key long")


def tested(pairs: DataFrame, docs: DataFrame, marks: DataFrame) -> DataFrame:
    """(a, b, least, most, linked): bounds of the Jaccard distance of each pair, and whether it is a link.

    Pairs that sizes and parities leave open are verified on the whole texts; their
    bounds are exact.
    """
    bounds = cut_lineage(bounded_pairs(pairs, marks))
    maybe = (100 + PERCENT) * F.col("most") >= PERCENT * F.col("total")
    far = bounds.filter(~maybe).select("a", "b", F.col("most").alias("shared"), "total", F.lit(False).alias("exact"))
    near = bounds.filter(maybe).select("a", "b").distinct()
    shared = F.col("shared")
    link = F.col("exact") & (shared > 0) & (100 * shared >= PERCENT * (F.col("total") - shared))
    distance = 1 - shared / (F.col("total") - shared)
    rows = far.unionByName(verified(near, docs).withColumn("exact", F.lit(True)))
    # several rows only where one id has several texts
    return cut_lineage(
        rows.groupBy("a", "b").agg(
            F.min(distance).alias("least"),
            F.max(F.when(F.col("exact"), distance).otherwise(1.0)).alias("most"),
            F.max(link).alias("linked"),
        )
    )


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """(a, b, shared, total) of the pairs, counted on their whole texts."""
    pairs = cut_lineage(pairs)
    nodes = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    packed = cut_lineage(packed_texts(docs).join(cut_lineage(nodes), "doc_id", "left_semi"))
    side = lambda c: packed.select(F.col("doc_id").alias(c), F.col("body").alias(f"{c}_body"))
    rows = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "a_body", "b_body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, unpack = Words(lower=True), zstandard.ZstdDecompressor()
        known: dict[bytes, np.ndarray] = {}
        held = 0
        for whole in batches:
            for start in range(0, whole.num_rows, 64):
                batch = whole.slice(start, 64)
                a, b = batch.column("a_body").to_pylist(), batch.column("b_body").to_pylist()
                if held > 1_000_000:  # tokens; texts come again where one is linked to many
                    known, held = {}, 0
                new = list({x for x in (*a, *b) if x not in known})
                for body, s in zip(new, shingle_sets(pa.array(map(unpack.decompress, new), pa.binary()), words)):
                    known[body] = s
                    held += len(s)
                shared = [len(np.intersect1d(known[x], known[y], assume_unique=True)) for x, y in zip(a, b)]
                total = [len(known[x]) + len(known[y]) for x, y in zip(a, b)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("a"), batch.column("b"), pa.array(shared, pa.int64()), pa.array(total, pa.int64())],
                    ["a", "b", "shared", "total"],
                )

    return rows.mapInArrow(run, "a long, b long, shared long, total long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``docs``.

    Words are cut at ASCII white space and A-Z is lower-cased. A text with fewer
    than five words has one shingle, its whole sequence; a null or empty text has
    none, is linked with nothing and is its own component. Rows with the same id
    are versions of one document and share its links. A row without an id has no
    component. No rows give no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = cut_lineage(first_pass(docs))
    sets = counted.filter("n is not null").select("doc_id", "n", "set_key")
    amounts = class_counts(counted)

    known = sets.filter("set_key is not null and doc_id is not null")
    reps = cut_lineage(known.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.min("n").alias("n")))
    short = F.conv(F.substring(F.hex("set_key"), 1, 15), 16, 10).cast("long")
    nodes = cut_lineage(reps.select(short.alias("key"), F.col("rep").alias("node"), "n"))  # read twice, three numbers a row
    signed = cut_lineage(signatures(docs.filter("doc_id is not null"), amounts), "zstd")
    single = signed.select(F.posexplode("singles").alias("place", "sig"), "n", "key")
    single = single.select("sig", (F.shiftleft("n", 32) + F.col("n") - F.col("place")).alias("fit"), "key")
    met_alone = [cut_lineage(meeting(single.filter(F.pmod("sig", F.lit(PARTS)) == part))) for part in range(PARTS)]
    paired = signed.select(F.explode("pairs").alias("s"), "key").select("s.sig", "s.fit", "key")
    met = paired.groupBy("sig").agg(F.min("key").alias("x"), F.max("key").alias("y")).filter("x < y").select("sig")
    lists = cut_lineage(reduce(DataFrame.unionByName, [*met_alone, paired.join(cut_lineage(met), "sig").select("sig", "fit", "key")]))
    rest = F.max(F.col("fit").bitwiseAND(F.lit(0xFFFFFFFF))).cast("int").alias("rest")
    group = cut_lineage(lists.join(nodes, "key").groupBy("sig", "node", "n").agg(rest))
    wanted = cut_lineage(lists.select("key").distinct())
    marks = cut_lineage(
        signed.select("key", *marks_of()).join(wanted, "key", "left_semi").dropDuplicates(["key"]).drop("n").join(nodes, "key").drop("key")
    )
    marks = marks.select("node", "n", *[f"p{i}" for i in range(BITS // 64)])
    forget(signed, lists, wanted, *met_alone)

    # rows of one id with different texts
    tagged = known.join(reps, "set_key").select("doc_id", "rep")
    versions = cut_lineage(tagged.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).filter("a < b").select("doc_id", "a"))
    several = tagged.join(versions, "doc_id").filter("a <> rep").select("a", F.col("rep").alias("b")).distinct()
    pairs, group = parted(group)
    group = cut_lineage(led(group))
    seen = tested(cut_lineage(pairs.union(led_pairs(group)).distinct()), docs, marks)
    links = cut_lineage(seen.filter("linked").select("a", "b").union(several))
    comps = components(links)
    rows = still_open(group, seen, comps)
    if not rows.isEmpty():
        pairs = all_pairs(rows, marks).join(seen, ["a", "b"], "left_anti")
        more = tested(cut_lineage(pairs), docs, marks)
        comps = components(cut_lineage(links.union(more.filter("linked").select("a", "b"))))

    rep_comp = reps.join(comps.withColumnRenamed("node", "rep"), "rep", "left").select(
        "set_key", F.coalesce("comp", "rep").alias("comp")
    )
    rep_comp = cut_lineage(rep_comp)
    return sets.join(rep_comp, "set_key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id")).alias("component_id")
    )


def packed_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, body): texts compressed, as they are moved by id."""

    def work(batch: pa.RecordBatch, pack: zstandard.ZstdCompressor) -> pa.RecordBatch:
        bodies = [pack.compress(t.encode()) for t in texts_of(batch)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(bodies, pa.binary())], ["doc_id", "body"])

    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.filter("doc_id is not null").select("doc_id", "text")
    return by_batch(rows, work, f"doc_id {kind}, body binary", lambda: zstandard.ZstdCompressor(level=1))


def ordered(a: str, b: str) -> tuple[Column, Column]:
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


def parted(group: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pairs (a, b) of signatures with two nodes, and the rows, with ``size``, of those with more."""
    row = F.struct("node", "n", "rest")
    sizes = group.groupBy("sig").agg(F.count("*").alias("size"), F.min(row).alias("x"), F.max(row).alias("y"))
    sizes = cut_lineage(sizes.select("sig", "size", "x.*", F.col("y.node").alias("lnode"), F.col("y.n").alias("ln"), F.col("y.rest").alias("lrest")))
    two = sizes.filter("size = 2").filter(may_link("n", "rest", "ln", "lrest"))
    many = group.join(sizes.filter("size > 2").select("sig", "size"), "sig")
    return cut_lineage(two.select(*ordered("node", "lnode")).distinct()), cut_lineage(many)


def led(group: DataFrame) -> DataFrame:
    """``group`` with the leader of each signature, its size and rest: the node that meets most others.

    Of noisy copies that is the one nearest to all, since it has most tokens in common.
    """
    meets = cut_lineage(group.groupBy("node").agg(F.sum("size").alias("meets")))
    top = F.max(F.struct("meets", (-F.col("node")).alias("down"), "n", "rest")).alias("top")
    lead = group.join(meets, "node").groupBy("sig").agg(top)
    lead = lead.select("sig", (-F.col("top.down")).alias("leader"), F.col("top.n").alias("ln"), F.col("top.rest").alias("lrest"))
    return group.drop("size").join(cut_lineage(lead), "sig")


def led_pairs(group: DataFrame) -> DataFrame:
    """The pairs (a, b) of each signature's leader with those of its other nodes that it may be linked to there."""
    others = group.filter(F.col("leader") != F.col("node")).filter(may_link("n", "rest", "ln", "lrest"))
    return cut_lineage(others.select(*ordered("leader", "node")).distinct())


NEAR, BETWEEN, FAR = 0, 1, 2


def still_open(group: DataFrame, seen: DataFrame, comps: DataFrame) -> DataFrame:
    """(sig, node, n, rest, comp, kind): what is left to compare once all leaders were.

    A leader is done. ``kind`` is a node's distance from it: linked, further than 0.5,
    or between, which it also is where nothing is known. The Jaccard distance is a
    metric, so a linked node is further than 0.25 from every far one. Signatures whose
    rows are in one component are done.
    """
    pair = group.filter("leader <> node").select("sig", "node", "n", "rest", *ordered("leader", "node")).join(seen, ["a", "b"], "left")
    near, far = F.col("most") <= 1 - PERCENT / 100, F.col("least") > 2 * (1 - PERCENT / 100) + 1e-9
    kind = F.when(near, NEAR).when(far, FAR).otherwise(BETWEEN)
    marked = pair.withColumn("kind", kind).join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    rows = cut_lineage(marked.select("sig", "node", "n", "rest", "comp", "kind"))
    spans = rows.groupBy("sig").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.max(F.col("kind") == BETWEEN).alias("between"))
    # linked nodes have only those in between left to meet
    done = spans.select("sig", "between", (F.col("x") < F.col("y")).alias("open")).filter("open")
    return cut_lineage(rows.join(done.select("sig", "between"), "sig").filter(f"between or kind <> {NEAR}").drop("between"))


def all_pairs(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """The pairs (a, b) that are left: of one signature, in different components, of like size, with enough left."""
    # steps a little wider than the sizes of linked sets can differ: one row meets
    # its own step, the other its own and the one below
    step = F.floor(F.log("n") / F.log(F.lit(1.34))).cast("int")
    sized = cut_lineage(rows.join(folded(marks, JOIN_COLUMNS), "node").withColumn("step", step))
    below = F.explode(F.array(F.col("step"), F.col("step") - 1))
    meets = F.when(F.col("kind") == NEAR, F.array(F.lit(BETWEEN))).when(
        F.col("kind") == BETWEEN, F.array(F.lit(NEAR), F.lit(BETWEEN), F.lit(FAR))
    ).otherwise(F.array(F.lit(BETWEEN), F.lit(FAR)))
    own = [c for c in sized.columns if c not in ("sig", "kind")]
    other = sized.select("sig", "kind", *[F.col(c).alias(f"o{c}") for c in own], below.alias("step"))
    other = other.withColumn("kind", F.explode(meets))
    # the bounds are part of the join's condition: pairs that they rule out are never rows
    most, total = shared_at_most(F.col("n"), F.col("on"), "", "o", JOIN_COLUMNS), F.col("n") + F.col("on")
    once = (F.col("step") < F.col("ostep")) | (F.col("node") < F.col("onode"))
    left = may_link("n", "rest", "on", "orest")
    return sized.join(other, ["sig", "step", "kind"]).filter(
        once & (F.col("comp") != F.col("ocomp")) & left & ((100 + PERCENT) * most >= PERCENT * total)
    ).select(*ordered("node", "onode")).distinct()


def one_per_group(docs: DataFrame) -> DataFrame:
    """The rows and columns of ``docs`` without those whose document is linked to a smaller id."""
    drop = near_duplicates(docs).filter("component_id < doc_id").select(F.col("doc_id").alias("__drop")).distinct()
    return docs.join(drop, F.col("doc_id").cast("long") == F.col("__drop"), "left_anti")
