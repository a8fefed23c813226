"""Exact Jaccard self-join of shingle sets by token combinations, down to the classes of linked documents.

A set's shingles are ordered by a corpus-wide count, rare ones first. Two sets that link miss few of each other's shingles, so
the first ones of either hold some in common: a rare shingle is indexed alone, frequent ones only in pairs, and the
prefix is extended until what must be in common is at least one single or one pair. Pairs are formed inside parts of
the frequent shingles, whose number follows the size of the set, so that a set has about as many pairs as it would have singles.

Classes are wanted, not all pairs: the members of an index entry are first compared with its least member only. What that
links is one class, and later rounds compare members of an entry that are not in one class yet, against ever more of
its members, until every two are either in one class or compared. Candidates are verified on whole texts.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tabkit.llm.components import components
from tabkit.llm.shingles import MUL, mixed, shingle_sets
from tabkit.llm.rows import packed, unpacked
from tabkit.session import discard, fits_broadcast, store

SKETCH_BITS = 19
BLOCK_BITS = 12
PART_SHARE = 0.5
HOT_ROWS = 4096
ROUNDS = 32  # members of an entry that a later round compares with the others, times this each round
RECENT = 4096
FIRSTS = 32  # entries of a node that its rows carry, to tell where a pair meets
BITS = 512
MAP = [f"w{i}" for i in range(BITS // 64)]


def fingerprint(shingles: np.ndarray) -> tuple[int, int]:
    digest = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def bit_map(shingles: np.ndarray) -> np.ndarray:
    """Whether an odd number of shingles falls on each of ``BITS`` places.

    Where two sets' maps differ in d places, at least d shingles are in one of the sets only.
    """
    odd = np.bincount(((shingles >> np.uint64(8)) % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def profile(documents: DataFrame, size: int) -> DataFrame:
    """Per document ``id, digest, n, h1, h2`` and its bit map; per task also blocks of its counts of hashed shingles, one set counted once."""
    kind = documents.schema["id"].dataType.simpleString()
    id_type = to_arrow_type(documents.schema["id"].dataType)
    names, maps_kind = ["id", "digest", "n", "h1", "h2", *MAP, "block", "counts"], ", ".join(f"{w} bigint" for w in MAP)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.uint32)
        recent: set[tuple[int, int]] = set()
        for batch in batches:
            sizes, first, second, maps = [], [], [], []
            for s in shingle_sets((x.as_py() for x in batch.column(1)), size):
                mark = fingerprint(s)
                sizes.append(len(s))
                maps.append(bit_map(s))
                first.append(mark[0])
                second.append(mark[1])
                if mark not in recent:
                    if len(recent) >= RECENT:
                        recent.clear()
                    recent.add(mark)
                    np.add.at(counts, (s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), np.uint32(1))
            none = pa.nulls(len(sizes))
            words = np.array(maps, np.int64).reshape(-1, len(MAP))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64()),
                 *[pa.array(words[:, i].copy()) for i in range(len(MAP))], none.cast(pa.int32()), none.cast(pa.binary())], names)
        blocks = counts.reshape(-1, 1 << BLOCK_BITS)
        used = np.flatnonzero(blocks.any(1))
        none = pa.nulls(len(used))
        yield pa.RecordBatch.from_arrays(
            [none.cast(id_type), *[none.cast(pa.int64())] * (4 + len(MAP)), pa.array(used.astype(np.int32)),
             pa.array([blocks[b].tobytes() for b in used], pa.binary())], names)

    return documents.select("id", "text", F.xxhash64("text")).mapInArrow(run, f"id {kind}, digest bigint, n bigint, h1 bigint, h2 bigint, {maps_kind}, block int, counts binary")


def add_up(blocks: DataFrame) -> np.ndarray:
    """The tasks' counts summed, first in salted parts, then per block: 2 ** SKETCH_BITS numbers in all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, c in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = np.frombuffer(c.as_py(), np.uint64 if len(c.as_py()) == 8 << BLOCK_BITS else np.uint32).astype(np.uint64)
                sums[b] = sums[b] + part if b in sums else part
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["block", "counts"])

    salted = blocks.repartition("block", F.pmod(F.xxhash64("counts"), F.lit(16))).mapInArrow(run, "block int, counts binary")
    total = np.zeros((1 << SKETCH_BITS - BLOCK_BITS, 1 << BLOCK_BITS), np.uint64)
    for r in salted.repartition("block").mapInArrow(run, "block int, counts binary").collect():
        total[r[0]] = np.frombuffer(r[1], np.uint64)
    return total.ravel()


def need(n: int, percent: int) -> int:
    """Shingles of which one at least is shared by every set that links: one more than may be missing."""
    return n - (percent * n + 99) // 100 + 1


def _pairs_prefix(frequent: np.ndarray, rare: np.ndarray, parts: int, goal: int) -> tuple[int, np.ndarray]:
    """How long the prefix must be, and the part of each shingle. A part of g frequent ones gives g - 1."""
    part = ((frequent * MUL[3]) >> np.uint64(33)).astype(np.int64) % parts
    gain = rare.astype(np.int64)
    at = np.flatnonzero(~rare)
    if at.size:
        own = part[at]
        order = np.argsort(own, kind="stable")
        first = np.ones(at.size, bool)
        first[1:] = own[order][1:] != own[order][:-1]
        gains = np.ones(at.size, np.int64)
        gains[order[first]] = 0
        gain[at] = gains
    reached = np.searchsorted(np.cumsum(gain), goal)
    return min(int(reached) + 1, len(gain)), part


def signatures(s: np.ndarray, counts: np.ndarray, bound: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the combinations to index, and how many rows the sketch expects of each at most."""
    n = len(s)
    if n < 2:
        return s[:0], s[:0].astype(np.int64)
    c = counts[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
    order = np.lexsort((s, c))
    s, c = s[order], c[order].astype(np.int64)
    rare = c <= bound
    goal = need(n, percent)
    if rare[:goal].all():
        return s[:goal], c[:goal]
    out, expected, longest = [], [], 0
    # sets that link are of one level or of neighbouring ones: a level is a little wider than the widest ratio of sizes
    ratio = percent / 100 - 0.01
    own = int(math.log(n) / -math.log(ratio))
    for level in (own, own + 1):
        parts = max(1, int(PART_SHARE * (100 - percent) / 100 * ratio**-level))
        length, part = _pairs_prefix(s, rare, parts, goal)
        longest = max(longest, length)
        at = np.flatnonzero(~rare[:length])
        at = at[np.argsort(part[at], kind="stable")]
        group = part[at]
        for step in range(1, len(at)):
            same = group[step:] == group[:-step]
            if not same.any():
                break
            a, b = at[:-step][same], at[step:][same]
            low, high = np.minimum(s[a], s[b]), np.maximum(s[a], s[b])
            out.append(mixed(low * MUL[0] + high * MUL[1] + np.uint64(level)))
            expected.append(np.minimum(c[a], c[b]))
    single = rare[:longest]
    out.append(s[:longest][single])
    expected.append(c[:longest][single])
    return np.concatenate(out), np.concatenate(expected)


def index_entries(
    documents: DataFrame, counts: np.ndarray, bound: int, percent: int, size: int, second: frozenset[int], hot: int = HOT_ROWS
) -> DataFrame:
    """``sig, salt, node, n`` of every document; entries that may be long are dealt over salts (else -1)."""
    held = documents.sparkSession.sparkContext.broadcast(counts.astype(np.uint32 if counts.max(initial=0) < 2**32 else np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: set[int] = set()
        for batch in batches:
            sigs, salts, nodes, sizes = [], [], [], []
            for s in shingle_sets((x.as_py() for x in batch.column(0)), size):
                first, other = fingerprint(s)
                node = other if first in second else first
                if node in recent:
                    continue
                if len(recent) >= RECENT:
                    recent.clear()
                recent.add(node)
                sig, rows = signatures(s, held.value, bound, percent)
                sigs.append(sig)
                salts.append(np.where(rows > hot, node % np.maximum(-(-rows // hot), 1), -1).astype(np.int32))
                nodes.append(np.full(len(sig), node, np.int64))
                sizes.append(np.full(len(sig), len(s), np.int32))
            if sigs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(sigs).view(np.int64)), pa.array(np.concatenate(salts)), pa.array(np.concatenate(nodes)), pa.array(np.concatenate(sizes))],
                    ["sig", "salt", "node", "n"])

    return documents.select("text").mapInArrow(run, "sig bigint, salt int, node bigint, n int")


def shared_entries(entries: DataFrame) -> DataFrame:
    """``sig, node, n, low, low_n``: entries of more than one member with the least member of each salt.

    Of entries that hold the same members one stays: texts that share much meet in many entries, and one of them brings every
    pair. Entries dealt over salts stay all. A member that came twice did so in every entry of its, so sums over members tell sets apart.
    """
    # the join asks for this filter: stated here, both its uses of the dealt entries are one shuffle
    dealt = entries.filter("sig IS NOT NULL AND salt IS NOT NULL").repartition("sig", "salt")
    marks = [F.sum(F.shiftrightunsigned(F.xxhash64("node", F.lit(i)), 24)).alias(f"mark{i}") for i in (1, 2)]
    ends = dealt.groupBy("sig", "salt").agg(F.min(F.struct("node", "n")).alias("least"), F.max("node").alias("high"), F.count(F.lit(1)).alias("members"), *marks)
    ends = ends.filter("least.node <> high OR salt >= 0")
    one = ends.groupBy(F.when(F.col("salt") >= 0, F.col("sig")).alias("own"), "salt", "least", "high", "members", "mark1", "mark2").agg(F.min("sig").alias("_sig"))
    one = one.select("_sig", F.col("salt").alias("_salt"), "least")
    shared = dealt.join(one.hint("shuffle_hash"), (F.col("sig") == F.col("_sig")) & (F.col("salt") == F.col("_salt")))
    # a copy of a text in another task brings the same member again
    shared = shared.dropDuplicates(["sig", "salt", "node"])
    return shared.select("sig", "node", "n", F.col("least.node").alias("low"), F.col("least.n").alias("low_n"))


def verified(candidates: DataFrame, docs: DataFrame, nodes: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose sets reach the similarity, stored.

    Only texts of nodes in the pairs are fetched: those of ``b`` for each pair, straight to where ``a`` is.
    """
    pairs = store(candidates)
    row = [F.col("row.id").alias("_id"), F.col("row.digest").alias("_digest")]
    asked = store(pairs.join(nodes, F.col("b") == F.col("node")).select("a", "b", *row))
    heads = store(nodes.join(pairs.select(F.col("a").alias("node")).distinct(), "node", "left_semi").select("node", *row))
    right = texts_of(docs, asked).select("a", "b", F.col("text").alias("_tb"))
    left = texts_of(docs, heads).select(F.col("node").alias("_a"), F.col("text").alias("_ta")).dropDuplicates(["_a"])
    both = right.join(left, F.col("a") == F.col("_a")).select("a", "b", "_ta", "_tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_set = None, None
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            sets = shingle_sets((x.as_py() for x in batch.column(3)), size)
            keep = []
            for i, other in enumerate(sets):
                if a[i] != last:  # rows of one left side come together
                    last, last_set = a[i], next(shingle_sets([batch.column(2)[i].as_py()], size))
                common = len(last_set) + len(other) - len(np.union1d(last_set, other))
                if 100 * common >= percent * (len(last_set) + len(other) - common):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), batch.column(1).take(pa.array(keep, pa.int64()))], ["a", "b"])

    links = store(both.mapInArrow(run, "a bigint, b bigint"))
    discard(pairs, asked, heads)
    return links


def _sized(pairs: DataFrame, percent: int) -> DataFrame:
    """``a, b`` without pairs whose sizes ``na, nb`` alone keep them below the similarity."""
    return pairs.filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).select("a", "b").distinct()


def _maps(nodes: DataFrame, side: str) -> DataFrame:
    return nodes.select(F.col("node").alias(side), F.col("n").alias(f"n{side}"), *[F.col(w).alias(f"{side}{w}") for w in MAP])


def _may_link(percent: int) -> Column:
    """Whether sizes and bit maps of ``a`` and ``b`` leave room for the similarity: no pair that links is lost."""
    apart = F.lit(0)
    for w in MAP:
        apart = apart + F.bit_count(F.col(f"a{w}").bitwiseXOR(F.col(f"b{w}")))
    total = F.col("na") + F.col("nb")
    return ((total - apart) * (100 + percent) >= 2 * percent * total) & (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))


def _carried(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """Per node of the entries ``sig, node`` its bit map and the ``FIRSTS`` least of its entries."""
    firsts = members.groupBy("node").agg(F.slice(F.array_sort(F.collect_list("sig")), 1, FIRSTS).alias("firsts"))
    return firsts.join(nodes.select(F.col("node").alias("_node"), *MAP), F.col("node") == F.col("_node")).select("node", "firsts", *MAP)


def meetings(new: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """``a, b`` of different classes, ``a`` the lesser, that share an entry in which ``a`` is ``new``, and that may link.

    Pairs that share many entries meet in one of them: the least that is among the ``firsts`` of both, which both then are in. Only
    pairs that have none in common there, and so share a small part of their entries, meet in every entry they share. ``firsts``
    are the same in all rounds and an entry keeps its members until they are of one class, so no pair is missed.
    """
    side = lambda t, x: t.select(
        F.col("sig").alias(f"{x}sig"), F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("label").alias(f"l{x}"),
        F.col("firsts").alias(f"f{x}"), *[F.col(w).alias(f"{x}{w}") for w in MAP])
    # all that tells pairs out of question is part of the join, so that they are never rows
    room = (F.col("a") < F.col("b")) & (F.col("la") != F.col("lb")) & _may_link(percent)
    here = F.coalesce(F.get(F.array_intersect("fa", "fb"), F.lit(0)), F.col("asig")) == F.col("asig")
    return side(new, "a").join(side(members, "b"), (F.col("asig") == F.col("bsig")) & room & here).select("a", "b")


def one_of_each(documents: DataFrame, links: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``documents`` that stay when each component of ``links`` keeps one: that of least id, then least digest.

    Components are told apart by ``class_label``, as several may have one ``component_id``: a null one, or an id that unlike rows share.
    Of repeated rows one stays. Rows without words are linked with nothing and all stay.
    """
    keep = links.filter("n_shingles > 0").groupBy("class_label").agg(
        F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col("digest").alias("digest"))).alias("k"))
    keep = keep.select(F.col("k.id").alias("_kid"), F.col("k.digest").alias("_kdigest"))
    doc = F.col("doc")
    rows = packed(documents)
    worded = F.coalesce(F.length(F.translate(doc[text_col], " \t\n\x0b\x0c\r", "")) > 0, F.lit(False))
    chosen = rows.filter(worded).join(keep, doc[id_col].eqNullSafe(F.col("_kid")) & (F.xxhash64(doc[text_col]) == F.col("_kdigest")))
    one = Window.partitionBy("_kid", "_kdigest").orderBy(F.xxhash64("doc"))
    chosen = chosen.withColumn("_n", F.row_number().over(one)).filter("_n = 1")
    return unpacked(chosen.select("doc").union(rows.filter(~worded)), documents.columns, {})


def link_documents(
    documents: DataFrame, size: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text",
    rare: int | None = None, hot: int = HOT_ROWS, rounds: int = ROUNDS,
) -> DataFrame:
    """``id, digest, n_shingles, component_id, class_label`` per document; ``digest`` is the text's ``xxhash64``.

    A document's set holds its distinct shingles of ``size`` words (see ``shingles``); with fewer words the whole sequence
    is its one shingle. Two documents link when 100 * intersection >= percent * union; a component's id is the
    least document id that links reach, and its ``class_label`` a number that no other component has. Documents without words
    are linked with nothing and have no label.

    Null text counts as empty. Rows of equal sets are one node, so copies and repeated rows cost no comparisons; a null id is
    passed over where a least id is taken (null where a component has no other). Empty tables give no rows; other columns are not read.

    ``rare`` is the count up to which a shingle is indexed alone (by default about twice what a bucket of the sketch holds);
    it and the two numbers after it steer the work, not the result.
    """
    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    seen = store(profile(docs, size))
    rows = seen.filter("block IS NULL").drop("block", "counts")
    # two sets of one 64-bit mark: take the other half for those (none are expected below billions of documents)
    clash = rows.groupBy("h1").agg(F.min("h2").alias("x"), F.max("h2").alias("y")).filter("x <> y").select("h1")
    if not fits_broadcast(clash):
        raise ValueError("too many sets share a mark")
    second = frozenset(r[0] for r in clash.collect())
    marks = rows.withColumn("node", F.when(F.col("h1").isin(list(second)), F.col("h2")).otherwise(F.col("h1")) if second else F.col("h1"))
    worded = marks.filter("n > 0")
    nodes = store(worded.groupBy("node", "n").agg(
        F.min("id").alias("least"), F.min(F.struct(F.col("id").isNull().alias("none"), "id", "digest")).alias("row"), *[F.min(w).alias(w) for w in MAP]))
    counts = add_up(seen.filter("block IS NOT NULL").select("block", "counts"))
    bound = int(2 * counts.mean() + 6 * math.sqrt(counts.mean()) + 8) if rare is None else rare
    entries = store(shared_entries(index_entries(docs, counts, bound, percent, size, second, hot)))
    labels = _classes(docs, entries, nodes, size, percent, rounds)
    known = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = known.groupBy("label").agg(F.min("least").alias("component_id"))
    named = known.join(least, "label").select(F.col("node").alias("_node"), "component_id", F.col("label").alias("class_label"))
    out = marks.join(named, (F.col("node") == F.col("_node")) & (F.col("n") > 0), "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), "digest", F.col("n").alias("n_shingles"), component.alias("component_id"), "class_label")


def _classes(
    docs: DataFrame, entries: DataFrame, nodes: DataFrame, size: int, percent: int, rounds: int
) -> DataFrame:
    """``node, label`` of the linked nodes."""
    # the least members of an entry's salts are an entry among themselves
    heads = entries.filter("node = low").select("sig", "node", "n")
    least = heads.groupBy(F.col("sig").alias("_sig")).agg(F.min(F.struct("node", "n")).alias("l"), F.max("node").alias("z")).filter("l.node <> z")
    of_heads = heads.join(least, F.col("sig") == F.col("_sig")).select("l.node", "l.n", "node", "n")
    first = entries.select("low", "low_n", "node", "n").union(of_heads).toDF("a", "na", "b", "nb").filter("a <> b")
    mapped = _sized(first, percent).join(_maps(nodes, "b"), "b")
    right = _maps(nodes, "a").withColumnRenamed("a", "_a")
    candidates = mapped.join(right, (F.col("a") == F.col("_a")) & _may_link(percent)).select("a", "b")
    links = verified(candidates, docs, nodes, size, percent)
    labels = components(links)
    discard(links)
    low, high = 0.0, 1.0 * rounds
    open_ = kept = entries
    carried = None
    while True:
        # entries whose members are not all in one class
        classed = open_.select("sig", "node", "n").join(labels, "node", "left").select("sig", "node", "n", F.coalesce("label", "node").alias("label"))
        mixed_up = classed.groupBy("sig").agg(F.min("label").alias("l"), F.max("label").alias("h"), F.count(F.lit(1)).alias("m")).filter("l <> h")
        mixed_up = classed.join(mixed_up.select(F.col("sig").alias("_sig"), "m"), F.col("sig") == F.col("_sig"))
        before, open_ = kept, store(mixed_up.select("sig", "node", "n", "label", "m"))
        kept = open_
        discard(before)
        share = (F.col("node").cast("double") + float(2**63)) / float(2**64) * F.col("m")
        most = open_.agg(F.max("m")).first()[0]
        if most is None:
            break
        carried = store(_carried(open_, nodes)) if carried is None else carried
        wide = store(open_.join(carried, "node"))
        # node numbers are hashes: this takes about ``high`` members of each entry, all of them in short entries and at the end, and none twice
        new = wide.filter((share >= low) & ((share < high) | (F.col("m") <= high) | F.lit(high >= most)))
        more = verified(meetings(new, wide, percent).distinct(), docs, nodes, size, percent)
        discard(wide)
        if not more.isEmpty():
            # the classes so far are stars already, so only what the new links join has to move
            labels = components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).union(more))
        discard(more)
        if high >= most:
            break
        open_ = open_.filter(F.col("m") > high)
        low, high = high, high * max(2, rounds)
    discard(kept, *([] if carried is None else [carried]))
    return labels


def texts_of(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """``asked`` with the ``text`` of the rows of id ``_id`` and text digest ``_digest``; a repeated row brings it again."""
    asked = F.broadcast(asked) if fits_broadcast(asked) else asked
    return docs.join(asked, F.col("id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_digest")))
