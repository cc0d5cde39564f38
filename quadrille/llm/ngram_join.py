"""Jaccard join on word n-grams, with rare-first prefix filtering.

A document is the set of its distinct word shingles, as 64-bit hashes. Equal sets are one class. The shingles of
a set are ordered rare first, by counts over all documents that are kept in a table of fixed size (any order
that all documents share is right; a rough count only costs candidates). Two sets that reach the threshold
share a shingle within the prefixes of both, so only prefix shingles are joined.

To link a group of copies without listing all its pairs, each class is first compared with a representative of a
shingle that it shares and with a few neighbours; what is linked so is contracted at once, so that a round meets
components, not links. Shingles whose holders all lie in one component are done, and of the others only pairs with
a holder outside the most frequent component are listed. The rest is joined pair by pair, under the index prefix, length, positional and suffix filters, across
components only. The suffix filter bounds the Hamming distance of two sets from below without their members: by
the parities of the numbers of shingles between 512 fixed pivots, since each shingle that only one set has flips
one parity, and by the numbers between 32 of them. Every pair left is verified once on the whole texts.

Cases: a null or empty text, or one without a word, has the empty set and is linked with nothing; fewer words
than a shingle has make one shingle; repeated rows are one class; a null doc_id stands below every other id; an
empty table gives no rows. Two different sets are taken for one with a chance of 2**-64 a pair.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import NULL_ID, narrow, partitions, sliced, texts_of, written
from .components import components

#: Buckets of the table of counts, in blocks that are summed apart; its size never grows.
BUCKET_BITS, BLOCKS = 20, 256
#: Pivots of the suffix filter.
PIVOTS, PARITY_BITS = 32, 9
SIGNS = [f"s{i}" for i in range((1 << PARITY_BITS) // 64)]
#: Members verified beside one copy of their representative; holders of a shingle in one share of its pairs; neighbours.
BESIDE, SHARE, NEIGHBOURS = 64, 2048, 7
#: Bits of the filter of ids, at most, and of one block of it.
FILTER_BITS, BLOCK_BITS = 26, 16
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: bytes, k: int) -> np.ndarray:
    """The sorted distinct hashes of the text's k-word shingles."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    size = min(k, n)
    roll = h[: n - size + 1].copy()
    for j in range(1, size):
        roll = roll * _BASE + h[j : n - size + 1 + j]
    return np.unique(_mixed(roll + np.uint64(size)))


def class_of(s: np.ndarray) -> int:
    return int(np.frombuffer(xxhash.xxh3_64_digest(s.tobytes()), "<i8")[0]) if len(s) else 0


def buckets(x: np.ndarray) -> np.ndarray:
    return (_mixed(x ^ _BASE) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


# --- tables of counts by hash bucket -------------------------------------------------------------------------


def _blobs(counts: np.ndarray) -> list[bytes]:
    return [zlib.compress(x.tobytes(), 1) for x in counts.reshape(BLOCKS, -1)]


def _summed(pdf: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(zlib.decompress(x), "<i8") for x in pdf["blob"])
    return pd.DataFrame({"block": pdf["block"].iloc[:1], "salt": [0], "blob": [zlib.compress(total.tobytes(), 1)]})


def total_counts(parts: DataFrame) -> np.ndarray:
    """The sum of the tables in (block, salt, blob) rows, one set of blocks a task; two steps, so that no task meets all."""
    for keys in (("block", "salt"), ("block",)):
        parts = parts.groupBy(*keys).applyInPandas(_summed, "block int, salt int, blob binary").coalesce(8)  # of fixed size
    out = np.zeros((BLOCKS, (1 << BUCKET_BITS) // BLOCKS), np.int64)
    for r in parts.collect():  # BLOCKS rows, of fixed size
        out[r.block] = np.frombuffer(zlib.decompress(r.blob), "<i8")
    return out.ravel()


def _counting(batches: Iterator[pa.RecordBatch], hashes_of) -> np.ndarray:
    counts = np.zeros(1 << BUCKET_BITS, np.int64)
    for b in batches:
        h = hashes_of(b)
        if len(h):
            counts += np.bincount(buckets(h), minlength=1 << BUCKET_BITS)
    return counts


def _table_rows(counts: np.ndarray) -> pa.RecordBatch:
    salt = int(counts[:4096].sum() + np.flatnonzero(counts)[0]) % 16
    return pa.RecordBatch.from_arrays([pa.array(np.arange(BLOCKS, dtype=np.int32)), pa.array(np.full(BLOCKS, salt, np.int32)), pa.array(_blobs(counts), pa.binary())], names=["block", "salt", "blob"])


# --- texts by id ---------------------------------------------------------------------------------------------


def _slots(ids: np.ndarray, bits: int) -> np.ndarray:
    return (_mixed(ids.view(np.uint64) ^ _BASE) >> np.uint64(64 - bits)).astype(np.int64)


def _filter_of(bits: int):
    """The blocks of a task's bit map that hold an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = np.zeros(1 << bits, bool)
        for b in batches:
            mask[_slots(b.column("id").to_numpy(), bits)] = True
        blocks = mask.reshape(-1, 1 << BLOCK_BITS)
        at = np.flatnonzero(blocks.any(1))
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array([np.packbits(blocks[i]).tobytes() for i in at], pa.binary())], names=["block", "bits"])

    return run


def _either(pdf: pd.DataFrame) -> pd.DataFrame:
    got = np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in pdf["bits"]])
    return pd.DataFrame({"block": pdf["block"].iloc[:1], "bits": [got.tobytes()]})


def _wanted(packed: np.ndarray, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = _slots(b.column("id").to_numpy(), bits)
            if (keep := (packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)).any():
                yield b.filter(pa.array(keep))

    return run


def only_ids(keyed: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """The rows (id, text) whose id is among ``ids`` (about ``n`` rows), and few others.

    A bit map of the ids' hashes goes to the tasks: 16 bits an id, at most 2 ** ``FILTER_BITS`` bits (8 MB). Beyond
    four million ids it lets more and more others through, which the join that follows takes out.
    """
    bits = min(FILTER_BITS, max(BLOCK_BITS, (16 * n).bit_length()))
    parts = ids.mapInArrow(_filter_of(bits), "block int, bits binary").groupBy("block").applyInPandas(_either, "block int, bits binary")
    packed = np.zeros((1 << (bits - BLOCK_BITS), (1 << BLOCK_BITS) // 8), np.uint8)
    for r in parts.collect():  # at most 2 ** (FILTER_BITS - BLOCK_BITS) rows of 8 KB
        packed[r.block] = np.frombuffer(r.bits, np.uint8)
    return keyed.mapInArrow(_wanted(packed.ravel(), bits), "id long, text binary")


# --- passes over the texts -----------------------------------------------------------------------------------


def _sets(k: int):
    """Per document its size, class and counts between the pivots; after a task's last one, its table of counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << BUCKET_BITS, np.int64)
        names = ["id", "key", "n", "cls", "pivots", *SIGNS, "block", "salt", "blob"]
        for b in sliced(batches):
            sets = [shingles(t, k) for t in b.column("text").to_pylist()]
            if not sets:
                continue
            counts += np.bincount(buckets(np.concatenate(sets)), minlength=1 << BUCKET_BITS)
            piv = [np.bincount((s >> np.uint64(59)).astype(np.int64), minlength=PIVOTS).astype(np.int32) for s in sets]
            odd = np.packbits(np.stack([np.bincount((s >> np.uint64(64 - PARITY_BITS)).astype(np.int64), minlength=1 << PARITY_BITS) & 1 for s in sets]).astype(bool), axis=1).view("<i8")
            m = len(sets)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("key"), pa.array([len(s) for s in sets], pa.int64()), pa.array([class_of(s) for s in sets], pa.int64()), pa.array(piv, pa.list_(pa.int32())), *(pa.array(np.ascontiguousarray(x)) for x in odd.T), pa.nulls(m, pa.int32()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())], names=names)
        if counts.any():
            rows = _table_rows(counts)
            yield pa.RecordBatch.from_arrays([*(pa.nulls(BLOCKS, pa.int64()) for _ in range(4)), pa.nulls(BLOCKS, pa.list_(pa.int32())), *(pa.nulls(BLOCKS, pa.int64()) for _ in SIGNS), *rows.columns], names=names)

    return run


def prefix_size(n: int, percent: int) -> int:
    """Of n shingles, rare first, so many must hold one in common with any set that reaches the threshold."""
    return n - -(-percent * n // 100) + 1


def _prefixes(k: int, percent: int, rank: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            grams, cls, sizes, places = [], [], [], []
            for text in b.column("text").to_pylist():
                s = shingles(text, k)
                if not (n := len(s)):
                    continue
                p = prefix_size(n, percent)
                order = np.lexsort((s, rank[buckets(s)]))[:p]
                grams.append(s[order])
                cls.append(np.full(p, class_of(s), np.int64))
                sizes.append(np.full(p, n, np.int32))
                places.append(np.arange(p, dtype=np.int32))
            if grams:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(grams).view(np.int64)), *(pa.array(np.concatenate(x)) for x in (cls, sizes, places))], names=["g", "cls", "n", "pos"])

    return run


def _verified(k: int, percent: int):
    """Streams (b, salt) groups: the representative's text, then its members'."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, base = None, None
        for b in sliced(batches):
            out = []
            for cls, node, member, text in zip(*(b.column(c).to_pylist() for c in ("b", "a", "member", "text")), strict=True):
                if not member:
                    if cls != at:
                        s = shingles(text, k)
                        if class_of(s) == cls:  # rows may share a doc_id
                            at, base = cls, s
                elif cls == at:
                    s = shingles(text, k)
                    if class_of(s) == node:
                        both = len(np.intersect1d(s, base, assume_unique=True))
                        if 100 * both >= percent * (len(s) + len(base) - both):
                            out.append((node, cls))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return run


# --- the join ------------------------------------------------------------------------------------------------


def _verify(keyed: DataFrame, classes: DataFrame, pairs: DataFrame, k: int, percent: int, many: int) -> DataFrame:
    """Those of the distinct ``pairs`` (a, b) of classes that reach the threshold."""
    ca = classes.select(F.col("cls").alias("a"), F.col("rid").alias("ra"), F.col("n").alias("na"), F.col("pivots").alias("pa"))
    cb = classes.select(F.col("cls").alias("b"), F.col("rid").alias("rb"), F.col("n").alias("nb"), F.col("pivots").alias("pb"))
    met = pairs.join(ca, "a").join(cb, "b")
    small, large = F.least("na", "nb"), F.greatest("na", "nb")
    need = F.ceil(percent * (F.col("na") + F.col("nb")) / (100 + percent))
    apart = F.aggregate(F.zip_with("pa", "pb", lambda x, y: F.abs(x - y)), F.lit(0), lambda acc, x: acc + x)
    met = met.where((100 * small >= percent * large) & (apart <= F.col("na") + F.col("nb") - 2 * need))
    met = written(narrow(met.select("a", "ra", "b", "rb"), many))
    sizes = met.groupBy("b", "rb").agg(F.ceil(F.count("*") / BESIDE).cast("int").alias("salts"))
    texts = only_ids(keyed, met.select(F.explode(F.array("ra", "rb")).alias("id")), 2 * met.count())
    salted = met.join(sizes.select("b", "salts"), "b").select("a", "b", F.col("ra").alias("id"), F.pmod(F.xxhash64("a"), F.col("salts")).cast("int").alias("salt"), F.lit(True).alias("member"))
    heads = sizes.select(F.col("b").alias("a"), "b", F.col("rb").alias("id"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(False).alias("member"))
    rows = salted.unionByName(heads).join(texts, "id").select("b", "salt", "member", "a", "text")
    dealt = rows.repartition(partitions(keyed.sparkSession), "b", "salt").sortWithinPartitions("b", "salt", "member")
    return written(narrow(dealt.mapInArrow(_verified(k, percent), "a long, b long"), many, 200))


def _named(rows: DataFrame, labels: DataFrame, *cols: str) -> DataFrame:
    """``rows`` with the nodes in ``cols`` replaced by what ``labels`` (node, comp) call them."""
    for c in cols:
        to = labels.select(F.col("node").alias(c), F.col("comp").alias("__to"))
        rows = rows.join(to, c, "left").withColumn(c, F.coalesce("__to", c)).drop("__to")
    return rows


def _open(rows: DataFrame) -> DataFrame:
    """Rows (g, cls, n, pos, comp) of shingles that are held in two components or more, with ``m``, a shingle's holders,
    and ``minor``, whether the row is outside the component that holds the shingle most often.

    Every pair still to be looked at has a minor row; the two sums are partial before their shuffles."""
    held = rows.groupBy("g", "comp").agg(F.count("*").alias("k"))
    most = held.groupBy("g").agg(F.sum("k").alias("m"), F.max(F.struct("k", "comp")).alias("most"), F.count("*").alias("comps")).where("comps > 1")
    return rows.drop("m", "minor").join(most.select("g", "m", F.col("most.comp").alias("__most")), "g").withColumn("minor", F.col("comp") != F.col("__most")).drop("__most")


def _near_pairs(rows: DataFrame, turn: int) -> DataFrame:
    """A bounded number of pairs of classes of different components for each class; the turn changes which.

    One with a representative of a shingle that it holds, and some with its neighbours: each class takes one of its
    shingles, by hash, so that copies tend to take the same, and meets those next to it in an order by hash.
    """
    by = lambda *c: F.xxhash64(*c, F.lit(turn))
    lead = rows.groupBy("g").agg(F.min(F.struct(by("comp").alias("h"), "cls", "comp")).alias("r")).select("g", "r.cls", "r.comp", "r.h").toDF("g", "b", "bcomp", "h")
    star = rows.join(lead, "g").where("comp <> bcomp").groupBy(F.col("cls").alias("a")).agg(F.min(F.struct("h", "b")).alias("r")).select("a", F.col("r.b").alias("b"))
    taken = rows.groupBy("cls").agg(F.min(F.struct(by("g").alias("h"), "g", "m", "comp")).alias("t")).select("cls", "t.g", "t.m", "t.comp")
    # Many holders of one shingle are dealt into shares of about SHARE, others each time.
    dealt = Window.partitionBy("g", F.pmod(by("cls", "g"), F.ceil(F.col("m") / SHARE))).orderBy(by("cls"), "cls")
    beside = taken.select("cls", "comp", F.array(*[F.lead(F.struct("cls", "comp"), i).over(dealt) for i in range(1, NEIGHBOURS + 1)]).alias("next"))
    pairs = beside.select("cls", "comp", F.explode("next").alias("o")).where("o is not null and o.comp <> comp").select(F.greatest("cls", "o.cls").alias("a"), F.least("cls", "o.cls").alias("b"))
    return star.unionByName(pairs).distinct()


def _close_pairs(rows: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """All pairs of classes of different components that share an open shingle and pass every filter."""
    # A pair passes at the first shingle that both hold. If one of the three before it is held by both, it isn't the first.
    order = Window.partitionBy("cls").orderBy("pos")
    signed = rows.join(classes.select("cls", *SIGNS), "cls").withColumns({f"before{i}": F.lag("g", i).over(order) for i in (1, 2, 3)})
    indexed = F.expr(f"pos < n - cast(ceil({2 * percent} * n / {100 + percent}) as int) + 1")
    # The minor holders of a common shingle are dealt by a salt; each share meets all holders.
    signed = signed.withColumns({"shares": F.ceil(F.col("m") / SHARE).cast("int"), "index": indexed})
    fields = ("cls", "n", "pos", "comp", "minor", "index", "before1", "before2", "before3", *SIGNS)
    x = signed.where("minor").select("g", F.pmod(F.xxhash64("cls"), F.col("shares")).cast("int").alias("share"), *[F.col(c).alias(c + "x") for c in fields])
    y = signed.select("g", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), *[F.col(c).alias(c + "y") for c in fields])
    first = ~F.coalesce(F.greatest(*[F.col(f"before{i}x") == F.col(f"before{j}y") for i in (1, 2, 3) for j in (1, 2, 3)]), F.lit(False))
    nx, ny, px, py = (F.col(c).cast("long") for c in ("nx", "ny", "posx", "posy"))
    smaller = (nx < ny) | ((nx == ny) & (F.col("clsx") < F.col("clsy")))
    index = F.when(smaller, F.col("indexx")).otherwise(F.col("indexy"))
    reach = (100 + percent) * F.least(nx - px, ny - py) >= percent * (nx + ny)
    apart = sum(F.bit_count(F.col(c + "x").bitwiseXOR(F.col(c + "y"))) for c in SIGNS)
    suffix = (100 + percent) * (nx + ny - apart) >= 2 * percent * (nx + ny)
    once = smaller | ~F.col("minory")
    near = x.join(y, ["g", "share"]).where((F.col("compx") != F.col("compy")) & once & index & (100 * F.least(nx, ny) >= percent * F.greatest(nx, ny)) & reach & first & suffix)
    return near.select(F.when(smaller, F.col("clsx")).otherwise(F.col("clsy")).alias("a"), F.when(smaller, F.col("clsy")).otherwise(F.col("clsx")).alias("b")).distinct()


class Join(NamedTuple):
    """The documents (id, key, n, cls), the classes, the links verified, and the component (node, comp) of each linked class, or None."""

    docs: DataFrame
    classes: DataFrame
    links: list[DataFrame]
    labels: DataFrame | None
    many: int


def joined(docs: DataFrame, k: int = 4, percent: int = 85, dense: int = 16, key: Column | None = None) -> Join:
    """Links every two classes that reach the threshold, or that are in one component by other links.

    A round of some pairs a class is repeated while the shingles left open would list more than ``dense`` pairs a
    row and the round before has at least halved them; then the rest is joined. A round's links are contracted at
    once, so the next one looks at components only. ``key`` goes along with the documents.
    """
    keyed = texts_of(docs, (F.lit(0).cast("long") if key is None else key).alias("key")).select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("id"), "text", "key")
    both = written(keyed.mapInArrow(_sets(k), ", ".join(["id long, key long, n long, cls long, pivots array<int>", *(f"{x} long" for x in SIGNS), "block int, salt int, blob binary"])))
    counts = total_counts(both.where("blob is not null").select("block", "salt", "blob"))
    rank = np.floor(8 * np.log2(counts + 1.0)).astype(np.uint8)
    docs_ = both.where("blob is null").select("id", "key", "n", "cls")
    many = docs_.count()
    classes = written(narrow(both.where("n > 0").groupBy("cls").agg(F.min("id").alias("rid"), F.first("n").alias("n"), F.first("pivots").alias("pivots"), *(F.first(x).alias(x) for x in SIGNS)), many))
    keyed = keyed.select("id", "text")
    postings = written(keyed.mapInArrow(_prefixes(k, percent, rank), "g long, cls long, n int, pos int"))
    spread = postings.groupBy("g").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).where("lo <> hi").select("g")
    rows = written(_open(postings.join(spread, "g").distinct().withColumn("comp", F.col("cls"))))
    links: list[DataFrame] = []
    labels, turn, before = None, 0, None

    def contract(found: DataFrame) -> DataFrame:
        """Takes the links in; gives the components whose name changes."""
        nonlocal labels
        links.append(found)
        new = components(found if labels is None else _named(found, labels, "a", "b"), nodes=many)
        if labels is None:
            labels = new
        else:
            fresh = new.join(labels.select("node"), "node", "left_anti")
            labels = written(narrow(_named(labels, new, "comp").select("node", "comp").unionByName(fresh.select("node", "comp")), many))
        return new

    while True:
        left = rows.agg(F.sum(F.when(F.col("minor"), F.col("m"))), F.count("*")).first()
        if not left[1]:
            break
        if turn and (left[0] <= dense * left[1] or 2 * left[0] > before):
            contract(_verify(keyed, classes, _close_pairs(rows, classes, percent), k, percent, many))
            break
        found = _verify(keyed, classes, _near_pairs(rows, turn), k, percent, many)
        turn, before = turn + 1, left[0]
        if not found.isEmpty():
            rows = written(_open(_named(rows, contract(found), "comp")))
    return Join(docs_, classes, links, labels, many)


def linked_classes(docs: DataFrame, k: int = 4, percent: int = 85, dense: int = 16) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """(documents as id, key, n, cls), (classes), and the verified links of classes."""
    return joined(docs, k, percent, dense)[:3]


def _components(join: Join) -> DataFrame:
    """(cls, rid, comp) of every class."""
    own = join.classes.select("cls", "rid", F.col("cls").alias("comp"))
    return own if join.labels is None else _named(own, join.labels, "comp")


def jaccard_components(docs: DataFrame, k: int = 4, percent: int = 85, dense: int = 16) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest doc_id reachable by links, of every row."""
    join = joined(docs, k, percent, dense)
    labelled = _components(join)
    first = labelled.groupBy("comp").agg(F.min("rid").alias("component"))
    found = labelled.join(first, "comp").select("cls", "component")
    back = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    out = join.docs.join(found, "cls", "left").withColumn("component", F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")))
    return out.select(back("id").alias("doc_id"), F.col("n").alias("n_shingles"), back("component").alias("component_id"))


def representatives(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row of ``docs`` for each component: the smallest doc_id's, of rows that share that the one with the least hash.

    Rows are told apart by doc_id and a hash of all their columns, not by doc_id alone. Rows without a word are in no
    component and stay, repeated ones too; of equal rows with a word one stays.
    """
    rid = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))
    row = F.xxhash64(*docs.columns)
    join = joined(docs, k, percent, key=row)
    rows = join.docs.where("n > 0").groupBy("id", "key", "cls").agg(F.count("*").alias("copies"))
    named = rows.join(_components(join).select("cls", "comp"), "cls")
    first = named.groupBy("comp").agg(F.min(F.struct("id", "key")).alias("first"))
    marked = written(narrow(named.join(first, "comp").select(F.col("id").alias("__id"), F.col("key").alias("__row"), (F.struct("id", "key") == F.col("first")).alias("stays"), "copies"), join.many))
    here = docs.withColumns({"__id": rid, "__row": row})
    alone = here.join(marked.where(~F.col("stays") | (F.col("copies") > 1)).select("__id", "__row"), ["__id", "__row"], "left_anti")
    again = here.join(marked.where(F.col("stays") & (F.col("copies") > 1)).select("__id", "__row"), ["__id", "__row"], "left_semi").dropDuplicates(["__id", "__row"])
    return alone.select(*docs.columns).unionByName(again.select(*docs.columns))
