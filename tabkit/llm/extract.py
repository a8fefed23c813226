"""Main text of web pages: gradient-boosted trees judge the nodes of a page's tree, a hierarchical decoding chooses among them.

The trees read subtree density, links, attribute tokens, depth, place and siblings of a node. They are fitted by Spark on nodes of labelled
pages: texts of a bounded sample of the table in layouts of which every part is known (``layouts``). Each page is then parsed, judged and
decoded in one task; nothing is shuffled.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.llm.dom import decode, features, parse
from tabkit.llm.layouts import TOKENS, Layout
from tabkit.session import store

TOKEN_NUMBER = {t: i for i, t in enumerate(TOKENS)}


@dataclass(frozen=True)
class Settings:
    """What the fit reads: at most ``sample_pages`` pages of the table, laid out ``layouts`` times each."""

    sample_pages: int = 96
    layouts: int = 6
    trees: int = 20
    depth: int = 5
    step: float = 0.3
    seed: int = 17


@dataclass(frozen=True)
class Forest:
    """The trees as arrays: feature (-1 at a leaf), threshold, children, value."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log odds per row."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for root in self.roots.tolist():
            at = np.full(len(x), root)
            while True:
                f = self.feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                goes = x[rows, np.maximum(f, 0)] <= self.threshold[at]
                at = np.where(inner, np.where(goes, self.left[at], self.right[at]), at)
            total += self.value[at]
        return 2 * total


def _forest(model) -> Forest:
    """Read the fitted trees once, so that tasks can judge the nodes of a page where they parse it."""
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def walk(node, weight: float) -> int:
        at = len(feature)
        for part in (feature, left, right):
            part.append(-1)
        threshold.append(0.0)
        value.append(weight * node.prediction())
        if node.subtreeDepth() > 0:
            feature[at], threshold[at] = node.split().featureIndex(), node.split().threshold()
            left[at] = walk(node.leftChild(), weight)
            right[at] = walk(node.rightChild(), weight)
        return at

    for tree, weight in zip(model.trees, model.treeWeights):
        roots.append(walk(tree._java_obj.rootNode(), weight))
    return Forest(np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value), np.array(roots))


def sample_texts(pages: DataFrame, html_col: str, n: int) -> DataFrame:
    """``key, html`` of the ``n`` pages of least hash: the same ones at any partitioning, one of equal pages."""
    rows = pages.filter(F.length(html_col) > 0).select(F.xxhash64(html_col).alias("key"), F.col(html_col).alias("html"))
    # the keys alone are ordered; a second scan takes the texts
    keys = rows.select("key").distinct().orderBy("key").limit(n)
    return rows.join(F.broadcast(keys), "key", "left_semi").dropDuplicates(["key"])


def labelled_nodes(sample: DataFrame, settings: Settings) -> DataFrame:
    """``x, y`` of the nodes of the laid-out pages; nodes that hold parts of both kinds have no label and are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs, ys = [], []
            for key, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                blocks = [t for n in parse(html) for _, t in n.blocks] or ["text"]
                for i in range(settings.layouts):
                    nodes = parse(Layout(random.Random(f"{settings.seed} {key} {i}"), blocks).page(), labelled=True)
                    x = features(nodes, TOKEN_NUMBER)
                    known = [k for k, n in enumerate(nodes) if n.label is not None and not n.hidden]
                    xs += x[known].tolist()
                    ys += [float(nodes[k].label) for k in known]
            yield pa.RecordBatch.from_arrays([pa.array(xs, pa.list_(pa.float64())), pa.array(ys, pa.float64())], ["x", "y"])

    return sample.mapInArrow(run, "x array<double>, y double")


def fit_extractor(pages: DataFrame, html_col: str = "html", settings: Settings = Settings()) -> Forest | None:
    """The fitted trees; None where no page has any html."""
    nodes = store(labelled_nodes(sample_texts(pages, html_col, settings.sample_pages), settings).repartition(4, F.xxhash64("x")).sortWithinPartitions("x", "y"))
    if nodes.select("y").distinct().count() < 2:
        return None
    rows = nodes.select(array_to_vector("x").alias("features"), F.col("y").alias("label"))
    return _forest(GBTClassifier(maxIter=settings.trees, maxDepth=settings.depth, stepSize=settings.step, seed=settings.seed, maxBins=64).fit(rows))


def extract_text(
    pages: DataFrame, forest: Forest | None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", text_col: str = "text"
) -> DataFrame:
    """``page_id, url, text, n_chars``: the blocks of the article in page order, joined by a line feed.

    Character references are decoded, white space within a block is one blank. A null or empty page, and one without an article, has an
    empty text. Repeated rows give a row each; nulls in other columns are kept. An empty table gives no rows. Other columns are not read.
    """
    narrow = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kinds = [f.dataType.simpleString() for f in narrow.schema.fields[:2]]
    held = pages.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = held.value
        for batch in batches:
            texts = []
            for at in range(0, batch.num_rows, 64):
                parsed = [parse(x.as_py() or "") for x in batch.column(2)[at : at + 64]]
                x = np.concatenate([features(nodes, TOKEN_NUMBER) for nodes in parsed])
                score = trees.score(x) if trees else np.full(len(x), -1.0)
                for nodes, own in zip(parsed, np.split(score, np.cumsum([len(p) for p in parsed])[:-1])):
                    texts.append(decode(nodes, own))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["id", "url", "text"])

    out = narrow.mapInArrow(run, f"id {kinds[0]}, url {kinds[1]}, text string")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), F.col("text").alias(text_col), F.length("text").cast("long").alias("n_chars"))
