"""The main text of web pages: boosted trees on DOM nodes, decoded so that no node contradicts its ancestors.

The model is trained when it is needed, on ``TRAINING_PAGES`` labelled random layouts (a fixed number, the documented
bound of what it learns from); pages are then read, scored and decoded where they are, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lookfuse.llm import boosting, dom
from lookfuse.llm.layouts import Layouts

TRAINING_PAGES = 700
SEED = 11
#: Nodes scored at once.
NODES = 20_000


@lru_cache(maxsize=2)
def train(pages: int = TRAINING_PAGES, seed: int = SEED) -> boosting.BoostedTrees:
    layouts, rows, labels = Layouts(seed), [], []
    for _ in range(pages):
        page = dom.Page(layouts.page(), labelled=True)
        rows.append(dom.features(page))
        labels.extend(n.label for n in page.nodes)
    y = np.array(labels)
    return boosting.fit(np.concatenate(rows)[y >= 0], y[y >= 0].astype(float))


def main_texts(sources: list[str | None], model: boosting.BoostedTrees) -> list[str]:
    """The main text of each page: its content blocks in order, joined by an empty line."""
    out: list[str] = []
    held: list[tuple[dom.Page, np.ndarray]] = []

    def settle() -> None:
        if held:
            odds = model.log_odds(np.concatenate([f for _, f in held]))
            ends = np.cumsum([len(f) for _, f in held])
            for (page, _), own in zip(held, np.split(odds, ends[:-1]), strict=True):
                content = dom.decode(page, own)
                out.append("\n\n".join(text for node, text in page.blocks if content[node]))
            held.clear()

    for source in sources:
        page = dom.Page(source or "")
        held.append((page, dom.features(page)))
        if sum(len(f) for _, f in held) > NODES:
            settle()
    settle()
    return out


def extract(pages: DataFrame, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (page_id and url by default) with text and n_chars (its code points), for every row.

    The text is that of the article, without menus, headers, footers, sidebars, notices, adverts, forms, scripts,
    styles and comments; references are decoded and white space in a block is one space. A null or empty page, or one
    without an article, has an empty text. Very long pages are read whole, in time that grows with their length. Repeated rows get equal texts; other columns don't matter; an empty table
    gives an empty result.
    """
    keep = ["page_id", "url"] if keep is None else keep
    rows = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{html}`").cast("string").alias("__html"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("__html").schema]
    shared = pages.sparkSession.sparkContext.broadcast(train())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                texts = main_texts(batch.column(len(keep)).to_pylist(), model)
                columns = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[*keep, "text", "n_chars"])

    return rows.mapInArrow(run, ", ".join([*fields, "text string", "n_chars bigint"]))
