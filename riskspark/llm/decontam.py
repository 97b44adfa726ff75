"""Benchmark decontamination with one Aho-Corasick automaton.

Test items are normalised to words (A-Z lower-cased, everything in ASCII but
letters and digits separates) and cut into windows of `window` consecutive words;
an item with fewer words, but not none, is one window.  All windows go into one
automaton.  Each text is normalised the same way and scanned once; matches are
mapped back to words and to character offsets of the original text.

The windows are a written table in the shared folder, dealt by hash into groups of at most
about `max_bytes` (one, for a benchmark of some hundred thousand words).  A worker reads a
group's windows there and builds its automaton; the driver only counts them.  With several
groups a text is scanned once per group and its matches are merged.

Null texts have no words.  Items without an id still mark words as hit, but
are not listed.  Repeated rows give repeated results.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import LOWER, column, cut, map_batches, raw, scratch, store

#: Separators become a space; bytes from 0x80 on are part of words.
NORMAL = bytes(b if chr(b).isalnum() or b >= 0x80 else 32 for b in LOWER)
#: A trie takes some tens of bytes a byte of windows.
MAX_BYTES = 8 << 20
MATCHES = "item_ids array<string>, spans array<struct<start: long, end: long>>, n_words long, n_hit long"


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(NORMAL).split()


def windows(items: DataFrame, window: int) -> DataFrame:
    """Distinct (pattern, item_id): the windows of every item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pattern, ids = [], []
            for item, text in zip(column(b, "item_id").to_pylist(), raw(b, "text")):
                words = words_of(text)
                for i in range(max(1, len(words) - window + 1) if words else 0):
                    pattern.append(b" ".join(words[i : i + window]))
                    ids.append(item)
            yield pa.RecordBatch.from_arrays([pa.array(pattern, pa.binary()), pa.array(ids, pa.string())], names=["pattern", "item_id"])

    picked = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    return map_batches(picked, run, "pattern binary, item_id string").distinct()


class Automaton:
    """One group's windows, read from their folder and built once in each Python worker."""

    _built: tuple[str, ahocorasick.Automaton] | None = None

    def __init__(self, folder: str):
        self.key = folder

    def patterns(self) -> dict[bytes, list[str | None]]:
        fs, path = store(self.key)
        out: dict[bytes, list[str | None]] = {}
        if fs.get_file_info(path).type == pafs.FileType.Directory:
            rows = pq.read_table(path, filesystem=fs, columns=["pattern", "item_id"])
            for p, i in zip(rows["pattern"].to_pylist(), rows["item_id"].to_pylist()):
                out.setdefault(p, []).append(i)
        return out

    def get(self) -> ahocorasick.Automaton:
        if Automaton._built is None or Automaton._built[0] != self.key:
            a = ahocorasick.Automaton()
            patterns = self.patterns()
            for p, ids in patterns.items():  # Latin-1 keeps a byte a character
                a.add_word(f" {p.decode('latin-1')} ", (p.count(b" ") + 1, ids))
            if patterns:
                a.make_automaton()
            Automaton._built = (self.key, a)
        return Automaton._built[1]

    def scan(self, text: bytes | None) -> tuple[int, list[tuple[int, int, list]]]:
        """Number of words, and (first word, last word + 1, item ids) of each match."""
        a = self.get()
        words = words_of(text)
        if not words or not len(a):
            return len(words), []
        joined = f" {b' '.join(words).decode('latin-1')} "
        found = list(a.iter(joined))
        if not found:
            return len(words), []
        spaces = np.flatnonzero(np.frombuffer(joined.encode("latin-1"), np.uint8) == 32)
        ends = np.searchsorted(spaces, [e for e, _ in found]).tolist()
        return len(words), [(e - k, e, ids) for e, (_, (k, ids)) in zip(ends, found)]


def spans(text: bytes, hit: np.ndarray) -> list[dict[str, int]]:
    """Character spans in the original text of runs of hit words."""
    arr = np.frombuffer(text.translate(NORMAL), np.uint8)
    inside = np.r_[False, arr != 32, False]
    starts, ends = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(~inside[1:] & inside[:-1])
    chars = np.r_[0, np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)]
    run = np.r_[False, hit, False]
    first, last = np.flatnonzero(run[1:] & ~run[:-1]), np.flatnonzero(~run[1:] & run[:-1]) - 1
    return [{"start": int(chars[starts[i]]), "end": int(chars[ends[j]])} for i, j in zip(first, last)]


def automata(items: DataFrame, window: int, max_bytes: int) -> list[Automaton]:
    """One automaton, or as many as keep each within about `max_bytes` of windows."""
    found = cut(windows(items, window), "windows")
    size = found.agg(F.sum(F.length("pattern") + F.coalesce(F.length("item_id"), F.lit(0)) + 2)).first()[0] or 0
    groups = max(1, math.ceil(size / max_bytes))
    folder = scratch(items.sparkSession, "window-groups")
    dealt = found.withColumn("g", F.pmod(F.xxhash64("pattern"), F.lit(groups)))
    dealt.repartition("g").write.partitionBy("g").parquet(folder)
    return [Automaton(f"{folder}/g={g}") for g in range(groups)]


def _merge(text: bytes | None, n: int, found: list[tuple[int, int, list]]) -> tuple:
    edge = np.zeros(n + 1, np.int64)
    for i, j, _ in found:
        edge[i] += 1
        edge[j] -= 1
    hit = np.cumsum(edge)[:n] > 0
    ids = sorted({i for _, _, own in found for i in own if i is not None})
    return ids, spans(text, hit) if found else [], n, int(hit.sum())


def matches(docs: DataFrame, items: DataFrame, window: int = 10, max_bytes: int = MAX_BYTES) -> DataFrame:
    """One row per row of `docs`: doc_id, item_ids (with occurring windows, sorted
    as strings), spans (character offsets of runs of hit words), n_words, n_hit."""
    parts = automata(items, window, max_bytes)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    if len(parts) > 1:
        return _matches_by_group(docs, parts)
    auto = parts[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [_merge(t, *auto.scan(t)) for t in raw(b, "text")]
            ids, spn, n, hit = zip(*rows) if rows else ((), (), (), ())
            kinds = pa.list_(pa.string()), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.int64(), pa.int64()
            yield pa.RecordBatch.from_arrays([column(b, "doc_id"), *(pa.array(x, k) for x, k in zip((ids, spn, n, hit), kinds))], names=["doc_id", "item_ids", "spans", "n_words", "n_hit"])

    return map_batches(docs, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {MATCHES}")


def _matches_by_group(docs: DataFrame, parts: list[Automaton]) -> DataFrame:
    """The matches of several automata, met again by row and merged."""
    docs = cut(docs.withColumn("_row", F.monotonically_increasing_id()), "decontam-docs")
    found = None
    for auto in parts:
        def run(batches: Iterator[pa.RecordBatch], auto: Automaton = auto) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows = [(r, i, j, own) for r, t in zip(column(b, "_row").to_pylist(), raw(b, "text")) for i, j, own in auto.scan(t)[1]]
                r, i, j, own = zip(*rows) if rows else ((), (), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(r, pa.int64()), pa.array(i, pa.int64()), pa.array(j, pa.int64()), pa.array(own, pa.list_(pa.string()))], names=["_row", "i", "j", "own"])

        one = map_batches(docs, run, "_row long, i long, j long, own array<string>")
        found = one if found is None else found.union(one)
    met = docs.join(found.groupBy("_row").agg(F.collect_list(F.struct("i", "j", "own")).alias("found")), "_row", "left").drop("_row")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [_merge(t, len(words_of(t)), [(x["i"], x["j"], x["own"]) for x in own or []]) for t, own in zip(raw(b, "text"), column(b, "found").to_pylist())]
            ids, spn, n, hit = zip(*rows) if rows else ((), (), (), ())
            kinds = pa.list_(pa.string()), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.int64(), pa.int64()
            yield pa.RecordBatch.from_arrays([column(b, "doc_id"), *(pa.array(x, k) for x, k in zip((ids, spn, n, hit), kinds))], names=["doc_id", "item_ids", "spans", "n_words", "n_hit"])

    return map_batches(met, merge, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {MATCHES}")


def keep_clean(docs: DataFrame, items: DataFrame, window: int = 10, max_bytes: int = MAX_BYTES) -> DataFrame:
    """The rows of `docs` in whose text no window occurs, with all their columns."""
    parts = automata(items, window, max_bytes)
    for auto in parts:
        def run(batches: Iterator[pa.RecordBatch], auto: Automaton = auto) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield b.filter(pa.array([not auto.scan(t)[1] for t in raw(b, "text")], pa.bool_()))

        docs = map_batches(docs, run, docs.schema)
        if len(parts) > 1:  # one automaton in memory at a time
            docs = cut(docs, "decontam-kept")
    return docs


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


#: The same rows from DuckDB: windows and text positions met by equality.
SQL = r"""
with d as (
  select doc_id, row_number() over () as r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (
  select cast(item_id as varchar) as item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
win as (
  select distinct item, k, array_to_string(w[i:i + k - 1], ' ') as p
  from (select item, w, k, unnest(range(1, len(w) - k + 2)) as i from (select item, w, least(10, len(w)) as k from b where len(w) > 0))),
pos as (
  select r, i, k, array_to_string(w[i:i + k - 1], ' ') as p
  from (select r, w, k, unnest(range(1, len(w) - k + 2)) as i from d, (select distinct k from win) where len(w) >= k)),
hit as (select pos.r, pos.i, pos.k, win.item from pos join win on pos.p = win.p and pos.k = win.k),
n as (select r, count(distinct x) as n_hit from (select r, unnest(range(i, i + k)) as x from (select distinct r, i, k from hit)) group by r),
it as (select r, count(*) as n_items, string_agg(item, ',' order by item) as ids from (select distinct r, item from hit where item is not null) group by r)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(n.n_hit, 0) as bigint) as n_hit, cast(coalesce(it.n_items, 0) as bigint) as n_items,
  sha256(coalesce(it.ids, '')) as items_sha256, coalesce(n.n_hit, 0) > 0 as contaminated
from d left join n on n.r = d.r left join it on it.r = d.r
"""


def items_sha256(ids: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
