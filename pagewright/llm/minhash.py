"""Near-duplicate documents by ProbMinHash, banding, verification and components.

Every distinct k-word shingle of a document is an element of weight 1, however often it
occurs.  An element's Poisson process of that rate deals arrivals over the signature's
registers; a register keeps its first arrival, and a process ends as soon as its next arrival
is behind all registers of the document (early termination).  Two signatures agree in a
register with the probability Jaccard of the weighted sets, which at weight 1 is the Jaccard
of the shingle sets: candidates are found and ruled out on the measure that decides.

Documents of equal word sequence are one class from the start.  Each band bucket's members
are compared with its leader; members that this doesn't connect meet all others of the
bucket by signature (see ``components_by_signature``).  Candidate pairs whose signatures
could belong to similar texts are verified by the exact Jaccard of their shingle sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.components import connected_components
from pagewright.llm.shared import BROADCAST_BYTES, Words, document_key, fresh, mix, scratch, slices, slim, stash, text_bytes, unstash

SHINGLE = 5
SIMILARITY = 0.8
#: 32 bands of 6 registers: a pair of similarity 0.8 is missed with probability 6e-5, one of 0.5 seen with 0.4.
BANDS = 32
ROWS = 6
#: Standard errors below the similarity at which a signature estimate rules a pair out.
DOUBT = 4.0
#: Members of a block, and probes of a chunk, in expectation, and the bytes of their texts.
CELL = 1_024
CELL_BYTES = 8 << 20
#: Bytes of the cells that one task compares, in expectation (a larger cell is compared alone).
PART_BYTES = 32 << 20

_LOW44 = np.uint64((1 << 44) - 1)


def prob_minhash(elements: np.ndarray, weights: np.ndarray, doc: np.ndarray, n_docs: int, registers: int) -> np.ndarray:
    """Signatures (n_docs, registers) of weighted sets, 16 bits of the element a register; ``elements`` are 64-bit
    hashes, ``doc`` their documents."""
    first = np.full(n_docs * registers, np.inf)
    signature = np.zeros(n_docs * registers, np.uint16)
    behind = np.full(n_docs, np.inf)
    arrival = np.zeros(len(elements))
    active = np.arange(len(elements))
    step = 0
    while len(active):
        step += 1
        draw = mix(elements[active] + np.uint64(step * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        u = ((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        arrival[active] -= np.log(u) / weights[active]
        # what arrives behind all registers of its document is done, and so are its later arrivals
        active_doc = doc[active]
        early = arrival[active] < behind[active_doc]
        active, active_doc = active[early], active_doc[early]
        if not len(active):
            break
        register = (mix(draw[early] ^ np.uint64(0xD1B54A32D192ED03)) % np.uint64(registers)).astype(np.int64)
        place, at = active_doc * registers + register, arrival[active]
        np.minimum.at(first, place, at)
        won = first[place] == at
        signature[place[won]] = (elements[active[won]] >> np.uint64(7)).astype(np.uint16)
        touched = np.unique(active_doc)
        behind[touched] = first.reshape(n_docs, registers)[touched].max(1)
    return signature.reshape(n_docs, registers)


def _sets(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(element, document) of the distinct k-word shingles of each document, sorted by document."""
    hashes, first = words.shingles(k)
    doc = np.repeat(np.arange(len(first) - 1, dtype=np.uint64), np.diff(first))
    keys = np.unique(doc << np.uint64(44) | hashes >> np.uint64(20))
    return mix(keys & _LOW44), (keys >> np.uint64(44)).astype(np.int64)


_SIGNED = "doc_id long, row_hash long, k1 long, k2 long, size long, signature binary"


def _sign(k: int, registers: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        for lo, hi in slices(offsets):
            words = Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1])
            elements, doc = _sets(words, k)
            signatures = prob_minhash(elements, np.ones(len(elements)), doc, hi - lo, registers)
            k1, k2 = words.sequence_keys()
            empty = words.counts == 0
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(lo, hi - lo),
                    batch.column("row_hash").slice(lo, hi - lo),
                    pa.array(k1.view(np.int64), mask=empty),
                    pa.array(k2.view(np.int64), mask=empty),
                    pa.array(np.diff(offsets[lo : hi + 1])),
                    pa.array([None if e else s.tobytes() for e, s in zip(empty, signatures, strict=True)], pa.binary()),
                ],
                names=["doc_id", "row_hash", "k1", "k2", "size", "signature"],
            )


def band_hashes(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(n, bands) 64-bit bucket hashes."""
    parts = signatures[:, : bands * rows].reshape(len(signatures), bands, rows).astype(np.uint64)
    h = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), parts.shape[:2]).copy()
    for r in range(rows):
        h = mix(h ^ parts[:, :, r])
    return h


def _bands(bands: int, rows: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            signatures = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16).reshape(batch.num_rows, -1)
            ids = np.repeat(batch.column("id").to_numpy(), bands)
            yield pa.RecordBatch.from_arrays([pa.array(band_hashes(signatures, bands, rows).ravel().view(np.int64)), pa.array(ids)], names=["bucket", "id"])


def _agreeing(least: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures agree in at least that share of the registers."""
    for batch in batches:
        if batch.num_rows:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(batch.num_rows, -1) for c in ("signature_a", "signature_b"))
            yield batch.select(["a", "b"]).filter(pa.array((a == b).mean(1) >= least))


def jaccard(texts_a: pa.Array, texts_b: pa.Array, k: int = SHINGLE) -> np.ndarray:
    """Exact Jaccard of the k-word shingle sets of text pairs; 0 where both are without words."""
    out = np.zeros(len(texts_a))
    sides = [text_bytes(t) for t in (texts_a, texts_b)]
    for lo, hi in slices(sides[0][1] + sides[1][1]):
        keys = []
        for data, offsets in sides:
            hashes, first = Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1]).shingles(k)
            pair = np.repeat(np.arange(hi - lo, dtype=np.uint64), np.diff(first))
            keys.append(np.unique(pair << np.uint64(44) | hashes >> np.uint64(20)))
        both = np.sort(np.concatenate(keys))
        shared = both[1:][both[1:] == both[:-1]] if len(both) else both
        total, common = (np.bincount((x >> np.uint64(44)).astype(np.int64), minlength=hi - lo) for x in (both, shared))
        out[lo:hi] = common / np.maximum(1, total - common)
    return out


def _verified(k: int, similarity: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.select(["a", "b"]).filter(pa.array(jaccard(batch.column("text_a"), batch.column("text_b"), k) >= similarity - 1e-12))


def verify(pairs: DataFrame, texts: DataFrame, k: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """Of (a, b) pairs of ids, those whose (id, text) rows are similar.  Only the texts of paired ids are moved."""
    texts = _only(texts, pairs.select("a").union(pairs.select("b")).distinct().toDF("id"))
    joined = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(lambda b: _verified(k, similarity, b), "a long, b long")


def leaders(buckets: DataFrame) -> DataFrame:
    """(bucket, id, leader): every member but the leader of each bucket with two members or more.

    The leader is the member of the least hash, so that buckets of the same members are led by different ones.
    """
    led = buckets.groupBy("bucket").agg(F.min_by("id", F.xxhash64("id", "bucket")).alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return buckets.join(led, "bucket").where("id <> leader")


class _Sets:
    """Sorted shingle hashes of some texts, and how many a set shares with others."""

    def __init__(self, texts: pa.Array, k: int):
        parts, sizes = [np.zeros(0, np.uint64)], []
        data, offsets = text_bytes(texts)
        for lo, hi in slices(offsets):
            hashes, first = Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1]).shingles(k)
            keys = np.unique(np.repeat(np.arange(hi - lo, dtype=np.uint64), np.diff(first)) << np.uint64(44) | hashes >> np.uint64(20))
            parts.append(keys & _LOW44)
            sizes.append(np.bincount((keys >> np.uint64(44)).astype(np.int64), minlength=hi - lo))
        self.hashes = np.concatenate(parts)
        self.sizes = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.sizes)])

    def jaccard(self, row: int, others: np.ndarray) -> np.ndarray:
        """Of one text with others, none of them wordless."""
        own = self.hashes[self.first[row] : self.first[row + 1]]
        sizes = self.sizes[others]
        at = np.repeat(self.first[others] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        theirs = self.hashes[at]
        place = np.minimum(np.searchsorted(own, theirs), len(own) - 1)
        shared = np.add.reduceat((own[place] == theirs).astype(np.int64), np.cumsum(sizes) - sizes)
        return shared / (len(own) + sizes - shared)


def _compare(bands: int, rows_: int, least: float, k: int, similarity: float, table: pa.Table) -> pa.Table:
    """Similar pairs of a probe and a member of the same cell (bucket, block, chunk) that aren't connected yet.

    A pair that shares several buckets is judged in that of its first band only.
    """
    cell = np.unique(np.stack([table.column(c).to_numpy() for c in ("bucket", "block", "chunk")]), axis=1, return_inverse=True)[1].ravel()
    ids, component, probe, bucket = (table.column(c).to_numpy() for c in ("id", "component", "probe", "bucket"))
    signatures = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint16).reshape(len(ids), -1)
    band = (band_hashes(signatures, bands, rows_).view(np.int64) == bucket[:, None]).argmax(1)
    sets = _Sets(table.column("text").combine_chunks(), k)
    order = np.argsort(cell, kind="stable")
    edges = np.flatnonzero(np.diff(cell[order], prepend=-1, append=-1))
    found: list[tuple[int, int]] = []
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        rows = order[lo:hi]
        probes, members = rows[probe[rows]], rows[~probe[rows]]
        for p in probes.tolist():
            same = signatures[p] == signatures[members]
            alike = (same.mean(1) >= least) & (component[p] != component[members])
            if alike.any():
                at = members[alike]
                first = same[alike].reshape(len(at), bands, rows_).all(2).argmax(1)
                at = at[first == band[p]]
                if len(at):
                    linked = at[sets.jaccard(p, at) >= similarity - 1e-12]
                    found += [(min(int(ids[p]), i), max(int(ids[p]), i)) for i in ids[linked].tolist()]
    pairs = sorted(set(found))
    return pa.table({"a": pa.array([x for x, _ in pairs], pa.int64()), "b": pa.array([y for _, y in pairs], pa.int64())})


def _only(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``texts`` (id, text) with the given ids; before a shuffle if the ids are few enough to broadcast."""
    return texts.join(F.broadcast(ids), "id", "left_semi") if ids.count() * 8 <= BROADCAST_BYTES else texts


def components_by_signature(signed: DataFrame, texts: DataFrame, bands: int, rows: int, k: int, similarity: float) -> DataFrame:
    """(node, component) of ids linked, directly or through others, by similar texts that share a bucket.

    signed: (id, signature, size), texts: (id, text); ``size`` are the bytes of the text.

    First each bucket's members are compared with its leader, which connects groups of like
    texts at one comparison a member.  Then the members that are still apart from their leader
    meet all members of their bucket in cells of bounded size (a block of members and a chunk
    of such probes), where signatures rule out most pairs and the texts decide the others.
    The number of tasks that compare cells follows from the cells' bytes.
    """
    spark = signed.sparkSession
    least = max(0.0, similarity - DOUBT * (similarity * (1 - similarity) / (bands * rows)) ** 0.5)
    buckets = stash(signed.mapInArrow(lambda b: _bands(bands, rows, b), "bucket long, id long"), "buckets")
    led = stash(leaders(buckets), "led")
    pairs = led.select(F.least("id", "leader").alias("a"), F.greatest("id", "leader").alias("b")).distinct()
    a, b = (signed.select(F.col("id").alias(x), F.col("signature").alias(f"signature_{x}")) for x in "ab")
    both = pairs.join(a, "a").join(b, "b").select("a", "b", "signature_a", "signature_b")
    close = stash(both.mapInArrow(lambda t: _agreeing(least, t), "a long, b long"), "close")
    links = stash(verify(close, texts, k, similarity), "links")
    component = stash(connected_components(links), "components")

    everyone = led.union(led.select("bucket", "leader", "leader").distinct())
    members = everyone.join(component.withColumnRenamed("node", "id"), "id", "left").select("bucket", "id", "leader", F.coalesce("component", "id").alias("component"))
    members = members.join(component.toDF("leader", "leader_component"), "leader", "left").select("bucket", "id", "component", (F.col("component") != F.coalesce("leader_component", "leader")).alias("apart"))
    members = stash(members, "members")
    weighed = members.join(signed.select("id", "size"), "id")
    probes = F.col("apart").cast("long")
    sizes = weighed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"), F.sum(probes).alias("r"), F.sum(probes * F.col("size")).alias("probe_bytes")).where("r > 0")
    cut = lambda n, size: F.greatest(F.ceil(F.col(n) / CELL), F.ceil(F.col(size) / CELL_BYTES))
    sized = stash(weighed.join(sizes.select("bucket", cut("n", "bytes").alias("blocks"), cut("r", "probe_bytes").alias("chunks")), "bucket"), "sized")
    # bytes of a row besides its text: signature and numbers
    moved = F.col("size") + 2 * bands * rows + 64
    total = sized.agg(F.sum(moved * (F.col("chunks") + F.when(F.col("apart"), F.col("blocks")).otherwise(0)))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(total) // PART_BYTES))
    up_to = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    in_block = sized.select("bucket", F.pmod(F.xxhash64("id"), "blocks").alias("block"), up_to("chunks").alias("chunk"), "id", "component", F.lit(False).alias("probe"))
    as_probe = sized.where("apart").select("bucket", up_to("blocks").alias("block"), F.pmod(F.xxhash64("id", F.lit(1)), "chunks").alias("chunk"), "id", "component", F.lit(True).alias("probe"))
    wanted = _only(texts, sized.select("id").distinct())
    cells = in_block.unionByName(as_probe).join(signed.select("id", "signature").join(wanted, "id"), "id")
    part = F.pmod(F.xxhash64("bucket", "block", "chunk"), F.lit(parts))
    met = cells.withColumn("part", part).groupBy("part").applyInArrow(lambda t: _compare(bands, rows, least, k, similarity, t), "a long, b long")
    more = stash(met, "links")
    unstash(buckets, led, members, component, sized)
    return connected_components(links.union(more))


def _classes(documents: DataFrame, k: int = SHINGLE, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, row_hash, class_id, is_kept) of every row; rows equal in doc_id and text are one document."""
    with scratch() as keep:
        source = slim(documents, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row_hash"), "text")
        registers = bands * rows
        signed = stash(source.mapInArrow(lambda b: _sign(k, registers, b), _SIGNED), "signatures")
        worded = signed.where("k1 IS NOT NULL AND doc_id IS NOT NULL")
        # a document's id is its doc_id; where different texts share one, a hash of both
        shared = stash(worded.groupBy("doc_id").agg(F.min("row_hash").alias("least"), F.max("row_hash").alias("most")).where("least <> most").select("doc_id"), "shared-ids")
        n_shared = shared.count()

        def named(rows: DataFrame) -> DataFrame:
            if not n_shared:
                return rows.withColumn("id", F.col("doc_id"))
            marks = shared.withColumn("twice", F.lit(True))
            marked = rows.join(F.broadcast(marks) if n_shared * 8 <= BROADCAST_BYTES else marks, "doc_id", "left")
            return marked.withColumn("id", F.when(F.col("twice"), document_key(F.col("doc_id"), F.col("row_hash"))).otherwise(F.col("doc_id"))).drop("twice")

        # one signature for each text; written, so that the joins with it deal out their rows anew and can split hot keys
        first = F.struct("doc_id", "row_hash")
        texts = stash(named(worded).groupBy("k1", "k2").agg(F.min_by("signature", first).alias("signature"), F.min_by("id", first).alias("id"), F.min_by("size", first).alias("size"), F.min(first).alias("first")), "texts")
        components = components_by_signature(texts.select("id", "signature", "size"), named(source).select("id", "text"), bands, rows, k, similarity)
        placed = stash(texts.select("k1", "k2", "id", "first").join(components.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id")), "placed")
        kept = placed.groupBy("component").agg(F.min("first").alias("kept"))
        placed = stash(placed.join(kept, "component").select("k1", "k2", "kept"), "kept")
        both = signed.select("doc_id", "row_hash", F.when(F.col("doc_id").isNotNull(), F.col("k1")).alias("k1"), "k2").join(placed, ["k1", "k2"], "left")
        stays = F.col("kept").isNull() | ((F.col("doc_id") == F.col("kept.doc_id")) & (F.col("row_hash") == F.col("kept.row_hash")))
        return keep(stash(both.select("doc_id", "row_hash", F.coalesce("kept.doc_id", "doc_id").alias("class_id"), F.when(F.col("doc_id").isNotNull(), stays).alias("is_kept")), "classes"))


def near_duplicates(documents: DataFrame, **options) -> DataFrame:
    """(doc_id, class_id, is_kept) of every row: documents linked by similarity have the same class.

    ``class_id`` is the least doc_id of the class, ``is_kept`` marks that document.  Words are those of
    lower-cased text; a text of fewer words than ``k`` is one shingle.  Null, empty and
    wordless texts are alone in their class.  Rows equal in doc_id and text are one document;
    rows that only share a doc_id are different ones, of which the one with the least text
    hash is the first.  A null doc_id has a null class and is linked with nothing.  Very long
    texts are compared whole.  Other columns are ignored; an empty table gives no rows.
    """
    return _classes(documents, **options).drop("row_hash")


def keep_one(documents: DataFrame, **options) -> DataFrame:
    """Rows of ``documents`` (all columns), one of each class: the first document of the class.

    Of rows equal in doc_id and text one stays, whichever; rows that only share a doc_id are
    different documents and go only if their text's class has an earlier one.  Null, empty
    and wordless texts stay, and so do rows without a doc_id.  Columns of any name pass through.
    """
    classes = _classes(documents, **options)
    name, key = fresh(documents, "gone", "row_key")
    keyed = documents.withColumn(key, F.xxhash64("text"))

    def among(table: DataFrame, how: str) -> Callable[[DataFrame], DataFrame]:
        other = f"{key}_"
        table = table.select(F.col("doc_id").alias(name), F.col("row_hash").alias(other)).distinct()
        table = F.broadcast(table) if table.count() * 16 <= BROADCAST_BYTES else table
        return lambda rows: rows.join(table, (F.col("doc_id").cast("long") == F.col(name)) & (F.col(key) == F.col(other)), how)

    kept = among(classes.where("NOT is_kept"), "left_anti")(keyed)
    twice = stash(classes.where("is_kept").groupBy("doc_id", "row_hash").count().where("count > 1"), "repeated-rows")
    if not twice.isEmpty():
        kept = among(twice, "left_anti")(kept).unionByName(among(twice, "left_semi")(kept).dropDuplicates(["doc_id", key]))
    return kept.drop(key)
