"""Ranked lexical search: term-at-a-time scoring with limited accumulators, over blocks of an inverted index.

The corpus is cut into blocks of bounded size, each the postings of the query terms in its documents, stored once. Statistics
(documents, terms, document frequencies) are sums over blocks. A block scores every item on its own: terms from the rarest on,
each adding its weight to accumulators of documents. No accumulator is made once what the remaining terms can add at most stays below the
k-th partial score; those that exist are updated to the end, so their scores are exact, and no document left out could be among the k best.
The k best of all blocks hold the k best of the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tabkit.session import store

BLOCK_POSTINGS = 2_000_000
BLOCK_DOCUMENTS = 32_768
ITEM_BYTES = 4 << 20
SALTS = 64
#: Everything that is no letter or digit below code point 128 parts terms; only A-Z are lower-cased.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else 0x20 if b < 0x30 or 0x3A <= b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F else b
    for b in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text, in order and with repeats."""
    return text.encode().translate(_FOLD).split() if text else []


def item_blocks(items: DataFrame, id_col: str, text_col: str, size: int = ITEM_BYTES) -> Iterator[list[tuple]]:
    """Lists of ``(id, terms)``, each from about ``size`` bytes of text: what the driver and a broadcast hold at once."""
    block, held = [], 0
    for r in items.select(F.col(id_col), F.col(text_col)).toLocalIterator():
        found = sorted(set(terms_of(r[1])))
        if not found:
            continue
        block.append((r[0], found))
        held += len(r[1])
        if held >= size:
            yield block
            block, held = [], 0
    if block:
        yield block


INDEX_TYPES = "n_docs bigint, n_terms bigint, sizes binary, terms binary, starts binary, places binary, counts binary"


def build_index(documents: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """One row per block: ids and sizes of its documents, and per term of the vocabulary their places and counts.

    ``n_docs`` and ``n_terms`` count all documents with a term, also those that hold none of the vocabulary.
    """
    kind = documents.schema["id"].dataType
    id_type = to_arrow_type(kind)
    held = documents.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})
    width = len(vocabulary)

    def block(ids: list, sizes: list[int], seen: list[np.ndarray], n_docs: int, n_terms: int) -> pa.RecordBatch:
        keys = np.concatenate(seen) if seen else np.zeros(0, np.int64)  # place * width + term, each as often as it occurs
        keys, counts = np.unique(keys, return_counts=True)
        place, term = keys // max(width, 1), keys % max(width, 1)
        order = np.argsort(term, kind="stable")
        found, starts = np.unique(term[order], return_index=True)
        raw = [np.array(sizes, np.int64), found.astype(np.int32), np.append(starts, len(order)).astype(np.int64),
               place[order].astype(np.int32), counts[order].astype(np.int64)]
        return pa.RecordBatch.from_arrays(
            [pa.array([ids], pa.list_(id_type)), pa.array([n_docs], pa.int64()), pa.array([n_terms], pa.int64()),
             *[pa.array([x.tobytes()], pa.binary()) for x in raw]],
            ["ids", *[x.split()[0] for x in INDEX_TYPES.split(", ")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = held.value.get
        ids, sizes, seen, postings, n_docs, n_terms = [], [], [], 0, 0, 0
        for batch in batches:
            for i, x in enumerate(batch.column(1)):
                words = terms_of(x.as_py())
                if not words:
                    continue
                n_docs += 1
                n_terms += len(words)
                at = np.fromiter(map(number, words, repeat(-1)), np.int64, len(words))
                at = at[at >= 0]
                if not len(at):
                    continue
                seen.append(at + len(ids) * width)
                ids.append(batch.column(0)[i].as_py())
                sizes.append(len(words))
                postings += len(at)
                if postings >= BLOCK_POSTINGS or len(ids) >= BLOCK_DOCUMENTS:
                    yield block(ids, sizes, seen, n_docs, n_terms)
                    ids, sizes, seen, postings, n_docs, n_terms = [], [], [], 0, 0, 0
        if n_docs:
            yield block(ids, sizes, seen, n_docs, n_terms)

    return documents.select("id", "text").mapInArrow(run, f"ids array<{kind.simpleString()}>, {INDEX_TYPES}")


def document_frequencies(index: DataFrame, width: int) -> np.ndarray:
    """Documents per term: partial counts of each task, then their sums; as many numbers as the vocabulary has terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.int64)
        for batch in batches:
            for terms, starts in zip(batch.column(0), batch.column(1)):
                total[np.frombuffer(terms.as_py(), np.int32)] += np.diff(np.frombuffer(starts.as_py(), np.int64))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["term", "df"])

    out = np.zeros(width, np.int64)
    for r in index.select("terms", "starts").mapInArrow(run, "term int, df bigint").groupBy("term").agg(F.sum("df")).collect():
        out[r[0]] = r[1]
    return out


def best_of_block(
    item: np.ndarray, weight: np.ndarray, starts: dict[int, tuple[int, int]], places: np.ndarray, parts: np.ndarray,
    most: np.ndarray, n: int, k: int,
) -> tuple[np.ndarray, np.ndarray]:
    """Places and exact scores of a block's documents that may be among its ``k`` best, ties included.

    ``item`` lists term numbers from the rarest on; ``parts`` holds the part of each posting, ``most`` the largest of each term.
    """
    item = [t for t in item.tolist() if t in starts and weight[t] > 0]
    if not item:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    left = np.cumsum([int(weight[t]) * int(most[t]) for t in reversed(item)])[::-1]
    score, has = np.zeros(n, np.int64), np.zeros(n, bool)
    making, made = True, 0
    for t, bound in zip(item, left.tolist()):
        a, b = starts[t]
        at = places[a:b]
        if making and made >= k:
            own = score[has]
            making = bound >= np.partition(own, len(own) - k)[len(own) - k]
        if making:
            score[at] += weight[t] * parts[a:b]
            has[at] = True
            made = int(has.sum()) if made < k else made
        else:
            lives = has[at]
            score[at[lives]] += weight[t] * parts[a:b][lives]
    at = np.flatnonzero(score > 0)
    if len(at) > k:
        own = score[at]
        at = at[own >= np.partition(own, len(own) - k)[len(own) - k]]
    return at, score[at]


def _search_block(index: DataFrame, items: list[tuple], vocabulary: list[bytes], k: int, item_kind, id_kind) -> DataFrame:
    spark = index.sparkSession
    n_docs, n_terms = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    df = document_frequencies(index, len(vocabulary))
    n_docs, n_terms = n_docs or 0, n_terms or 1
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) if x else 0 for x in df], np.int64)
    number = {t: i for i, t in enumerate(vocabulary)}
    rarest = lambda ts: np.array(sorted((number[t] for t in ts), key=lambda t: (df[t], t)), np.int64)
    held = spark.sparkContext.broadcast(([rarest(ts) for _, ts in items], weights))
    id_type = to_arrow_type(id_kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, weight = held.value
        for batch in batches:
            for row in range(batch.num_rows):
                ids = batch.column(0)[row].as_py()
                sizes, terms, edges, places, counts = (
                    np.frombuffer(batch.column(i)[row].as_py(), kind)
                    for i, kind in enumerate((np.int64, np.int32, np.int64, np.int32, np.int64), 1))
                m = 50 + 50 * sizes * n_docs // n_terms
                parts = 1_000_000_000 * counts // (1000 * counts + 20 * m[places])
                most = np.zeros(len(weight), np.int64)
                if len(terms):
                    most[terms] = np.maximum.reduceat(parts, edges[:-1])
                starts = {t: (a, b) for t, a, b in zip(terms.tolist(), edges[:-1].tolist(), edges[1:].tolist())}
                who, docs, scores = [], [], []
                for i, item in enumerate(wanted):
                    at, score = best_of_block(item, weight, starts, places, parts, most, len(ids), k)
                    best = sorted(zip((-score).tolist(), [ids[p] for p in at.tolist()]), key=lambda x: (x[0], x[1] is None, x[1] if x[1] is not None else 0))[:k]
                    who += [i] * len(best)
                    docs += [d for _, d in best]
                    scores += [-s for s, _ in best]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(who, pa.int32()), pa.array(docs, id_type), pa.array(scores, pa.int64())], ["_item", "doc", "score"])

    found = index.select("ids", "sizes", "terms", "starts", "places", "counts").mapInArrow(
        run, f"_item int, doc {id_kind.simpleString()}, score bigint")
    # the best of a share of the blocks first, so that no task sees the candidates of all blocks
    order = [F.col("score").desc(), F.col("doc").asc_nulls_last()]
    found = found.withColumn("_salt", F.pmod(F.xxhash64("doc"), F.lit(SALTS)))
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("_item", "_salt").orderBy(*order))).filter(F.col("rank") <= k)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("_item").orderBy(*order))).filter(F.col("rank") <= k)
    names = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(items)], f"_number int, item {item_kind.simpleString()}")
    return found.join(F.broadcast(names), F.col("_item") == F.col("_number")).select("item", "rank", "doc", "score")


def ranked_search(
    documents: DataFrame, items: DataFrame, k: int = 50, doc_id: str = "doc_id", doc_text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents with a score above 0 for every item.

    Scores are integers: for each distinct term of the item, floor(1000 ln((2N + 2) / (2 df + 1))) times
    (10^9 tf) div (1000 tf + 20 m), m = 50 + (50 n N) div L. Equal scores go by ascending document id, nulls last.

    Null and empty texts hold no term: such items have no rows, such documents are not counted. Repeated documents are ranked each, and
    so are items: rows of one item id are ranked apart, each from 1. Empty tables give no rows. Other columns are not read.
    Items are taken in blocks of ``ITEM_BYTES`` of text; each block indexes and searches the whole corpus once.
    """
    docs = documents.select(F.col(doc_id).alias("id"), F.col(doc_text).alias("text"))
    item_kind, id_kind = items.schema[item_id].dataType, docs.schema["id"].dataType
    out = None
    for block in item_blocks(items, item_id, item_text):
        vocabulary = sorted({t for _, ts in block for t in ts})
        index = store(build_index(docs, vocabulary))
        found = _search_block(index, block, vocabulary, k, item_kind, id_kind)
        out = found if out is None else out.unionAll(found)
    if out is None:
        out = documents.sparkSession.createDataFrame([], f"item {item_kind.simpleString()}, rank int, doc {id_kind.simpleString()}, score bigint")
    return out.select(F.col("item").alias(item_id), "rank", F.col("doc").alias(doc_id), "score")
