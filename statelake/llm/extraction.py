"""Main text of web pages from wrappers that are inferred per host.

Every task aligns the pages it sees into one partial wrapper per host, so that a host with a third of
all pages sends one row per task. Partial wrappers are aligned in two steps (host and salt, then
host), and the wrapper of each host goes back to its pages: by broadcast while all wrappers together
are small, counted first, otherwise by a join on the host.

The text is that of a page's main part: the element that holds what differs from the host's other pages,
without menus, headers, footers, sidebars, notices, adverts, forms and comments. Names such as article
say where such a part ends; by themselves they decide only for hosts of a few pages, where nothing is
known to be the same everywhere. Blocks are joined by line ends in page order.

Defined cases: a NULL or empty page gives an empty text; a NULL or unreadable address is a host of its
own; markup, quotes and comments that never close end with the page, a tag in such a quote at the next
``>``; a page of any length or depth takes time in proportion to its length; repeated rows give equal
results; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from statelake.llm.common import fit_python, stored
from statelake.llm.wrappers import align, fold, main_texts, parse, wrapper_of

SALTS = 64
BROADCAST_BYTES = 16 * 1024 * 1024
HELD_HOSTS = 5_000


def host_of(url):
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def page_items(source: str | None) -> list:
    return fold(parse(source or "")[1])


def _partial_wrappers(pages: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def emit() -> pa.RecordBatch:
            columns = [pa.array(list(held)), pa.array([json.dumps(w) for w in held.values()], pa.string())]
            return pa.RecordBatch.from_arrays(columns, ["host", "wrapper"])

        for batch in batches:
            for host, source in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = wrapper_of(page_items(source.as_py()))
                held[host] = align(held[host], own) if host in held else own
            if len(held) > HELD_HOSTS:
                yield emit()
                held = {}
        if held:
            yield emit()

    return pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(run, "host string, wrapper string")


def _aligned(parts: DataFrame, *keys: str) -> DataFrame:
    """Partial wrappers of equal keys aligned into one, in the order of their text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple | None = None
        made: list = []
        out: list[tuple] = []

        def emit() -> pa.RecordBatch:
            columns = [pa.array([r[i] for r in out], pa.int32() if i and i < len(keys) else pa.string()) for i in range(len(keys) + 1)]
            return pa.RecordBatch.from_arrays(columns, [*keys, "wrapper"])

        for batch in batches:
            for *key, text in zip(*(batch.column(i).to_pylist() for i in range(len(keys) + 1)), strict=True):
                if tuple(key) == now:
                    made = align(made, json.loads(text))
                else:
                    if now is not None:
                        out.append((*now, json.dumps(made)))
                    now, made = tuple(key), json.loads(text)
            if len(out) > 500:
                yield emit()
                out = []
        if now is not None:
            out.append((*now, json.dumps(made)))
        if out:
            yield emit()

    schema = StructType([parts.schema[k] for k in keys] + [parts.schema["wrapper"]])
    grouped = parts.select(*keys, "wrapper").repartition(*keys).sortWithinPartitions(*keys, "wrapper")
    return grouped.mapInArrow(run, schema)


def host_wrappers(pages: DataFrame) -> DataFrame:
    """``(host, wrapper)``, the wrapper as JSON; written once."""
    fit_python(pages.sparkSession)
    salt = F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)).cast("int")
    salted = _partial_wrappers(pages).withColumn("salt", salt)
    return stored(_aligned(_aligned(salted, "host", "salt"), "host"), "wrappers")


def main_text(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every page."""
    wrappers = host_wrappers(pages)
    size = wrappers.agg(F.sum(F.octet_length("host") + F.octet_length("wrapper"))).first()[0] or 0
    side = F.broadcast(wrappers) if size <= BROADCAST_BYTES else wrappers
    joined = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host")).join(side, "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list] = {}
        for batch in batches:
            texts = []
            for source, text in zip(batch.column(2), batch.column(3), strict=True):
                name = text.as_py() or "[]"
                if name not in known:
                    if len(known) >= HELD_HOSTS:
                        known.clear()
                    known[name] = json.loads(name)
                texts.append("\n".join(main_texts(page_items(source.as_py()), known[name])))
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    made = StructType.fromDDL("text string, n_chars bigint")
    schema = StructType([pages.schema["page_id"], pages.schema["url"]] + made.fields)
    return joined.select("page_id", "url", "html", "wrapper").mapInArrow(run, schema)
