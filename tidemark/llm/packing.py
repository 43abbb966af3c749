"""Best-fit packing of token pieces into sequences, after Martello-Toth reduction.

How pieces are packed depends on how many there are of each length, and there are no more
lengths than a sequence has tokens. So Spark counts the lengths, the plan is made from those
counts alone, and every piece finds its place from its length and its number among the
pieces of that length. The plan has a few thousand lines at most, however many pieces.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.base import column, small_batches, stored

CAPACITY = 2048


class Encoder:
    """Token ids of texts as packed little-endian unsigned 32-bit numbers.

    The vocabulary is that of a byte-level BPE file of ``tokenizers``. Texts are encoded whole:
    to look known words up in a table costs more than to encode them again. Texts that hold
    an added token of the file ('<|endoftext|>') are encoded by ``tokenizers`` itself, unless
    ``special_as_text``: then it is text like any other.
    """

    def __init__(self, path: str, special_as_text: bool = True):
        with open(path, encoding="utf-8") as f:
            added = [t["content"] for t in json.load(f).get("added_tokens", [])]
        self.added = None if special_as_text or not added else re.compile("|".join(map(re.escape, added)))
        self.path, self.loaded = path, None  # 30 MB a worker, loaded for the first such text
        self.encoding = tiktoken.Encoding("bytes", pat_str=_PATTERN, mergeable_ranks=ranks(path), special_tokens={})

    def ids(self, text: str) -> bytes:
        if self.added and self.added.search(text):
            if self.loaded is None:
                self.loaded = Tokenizer.from_file(self.path)
            ids = self.loaded.encode(text, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        return self.encoding.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()


# Fixed value: how byte-level BPE cuts a text.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a byte-level BPE file; merges are ranked as their ids are.

    Such a file shows each byte as a printable character: those that are printable stand for
    themselves, the others follow in order from U+0100 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {chr(b): b for b in shown}
    byte |= {chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    special = {t["content"] for t in model.get("added_tokens", [])}
    return {bytes(byte[c] for c in t): i for t, i in model["model"]["vocab"].items() if t not in special}


@dataclass
class Bin:
    """``count`` sequences filled alike: (length, how many of it) in order, and free tokens."""

    count: int
    free: int
    parts: list[tuple[int, int]] = field(default_factory=list)


def reduce_dominated(counts: dict[int, int], capacity: int) -> tuple[list[Bin], dict[int, int]]:
    """Sequences that some best packing has for certain, and the counts that remain.

    From the longest length down, a set with that piece is fixed if no other feasible set
    with it is better: the piece alone if nothing fits beside it; with the longest piece
    that fits, if that fills the sequence or no two pieces fit beside it. Goes round until
    nothing more can be fixed.
    """
    left = {s: n for s, n in counts.items() if n}
    fixed: list[Bin] = []
    changed = True
    while changed:
        changed = False
        for s in sorted(left, reverse=True):
            while left.get(s):
                room = capacity - s
                others = sorted(k for k, n in left.items() if n > (k == s))
                if not others or others[0] > room:
                    fixed.append(Bin(left[s] if s > room else 1, room, [(s, 1)]))
                    take = {s: fixed[-1].count}
                else:
                    mate = max(k for k in others if k <= room)
                    smallest = others[0]
                    second = smallest if left[smallest] - (smallest == s) > 1 else (others[1] if len(others) > 1 else None)
                    if mate < room and second is not None and smallest + second <= room:
                        break
                    n = left[s] // 2 if mate == s else min(left[s], left[mate])
                    fixed.append(Bin(n, room - mate, [(s, 2)] if mate == s else [(s, 1), (mate, 1)]))
                    take = {s: 2 * n} if mate == s else {s: n, mate: n}
                for k, n in take.items():
                    left[k] -= n
                    if not left[k]:
                        del left[k]
                changed = True
    return fixed, left


def best_fit(counts: dict[int, int], capacity: int) -> list[Bin]:
    """Best-fit decreasing over counts: the longest pieces first, each into the fullest
    sequence that still has room, a new one if none has."""
    open_bins: dict[int, list[Bin]] = defaultdict(list)  # by free tokens
    full: list[Bin] = []

    def put(b: Bin, s: int, k: int, n: int) -> None:
        """``k`` pieces of length ``s`` into ``n`` of the sequences ``b``."""
        new = Bin(n, b.free - s * k, [*b.parts, (s, k)])
        (open_bins[new.free] if new.free else full).append(new)
        b.count -= n

    for s in sorted(counts, reverse=True):
        n = counts[s]
        for free in sorted(f for f in open_bins if f >= s):
            groups = open_bins.pop(free)
            while groups and n:
                b = groups.pop()
                k = free // s
                whole = min(b.count, n // k)
                if whole:
                    put(b, s, k, whole)
                    n -= whole * k
                if b.count and n:  # fewer than k are left: one more sequence takes them
                    put(b, s, n, 1)
                    n = 0
                if b.count:
                    groups.append(b)
            if groups:
                open_bins[free].extend(groups)
            if not n:
                break
        if n:
            k = capacity // s
            whole, rest = divmod(n, k)
            if whole:
                put(Bin(whole, capacity), s, k, whole)
            if rest:
                put(Bin(1, capacity), s, rest, 1)
    return full + [b for bins in open_bins.values() for b in bins]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> dict[int, np.ndarray]:
    """For each length rows of (first piece number, first sequence, pieces per sequence, offset)."""
    fixed, left = reduce_dominated(counts, capacity)
    lines: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    given: dict[int, int] = defaultdict(int)
    sequence = 0
    for b in fixed + best_fit(left, capacity):
        offset = 0
        for s, k in b.parts:
            lines[s].append((given[s], sequence, k, offset))
            given[s] += k * b.count
            offset += s * k
        sequence += b.count
    return {s: np.array(rows, np.int64) for s, rows in lines.items()}


def cut(n: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens; only the first may be shorter."""
    start, length = 0, n % capacity or min(n, capacity)
    while start < n:
        yield start, length
        start, length = start + length, capacity


def pieces(
    df: DataFrame, id_column: str, text: str, tokenizer: str, capacity: int = CAPACITY, special_as_text: bool = True
) -> DataFrame:
    """One row per piece, with its task and its number among that task's pieces of its length."""
    columns = ["id", "piece", "start", "length", "ids_crc32", "part", "nr"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, special_as_text)
        seen: dict[int, int] = defaultdict(int)
        for batch in batches:
            rows = []
            for doc, part, content in zip(batch["id"].to_pylist(), batch["part"].to_pylist(), batch["text"]):
                ids = encoder.ids(content.as_py()) + bytes(4)
                for i, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    rows.append((doc, i, start, length, crc, part, seen[length]))
                    seen[length] += 1
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], columns)

    rows = df.select(
        column(id_column).cast("long").alias("id"), F.spark_partition_id().alias("part"),
        F.coalesce(column(text), F.lit("")).alias("text"),
    )
    return rows.mapInArrow(
        encode, "id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nr bigint"
    )


def pack(
    df: DataFrame, tokenizer: str, id_column: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
    special_as_text: bool = True,
) -> DataFrame:
    """One row per piece of a document: ``piece``, ``start``, ``length``, ``ids_crc32``,
    ``sequence_id``, ``offset``.

    A document is its token ids and id 0; null and empty texts are that id alone. Documents
    longer than ``capacity`` are cut; all others stay whole. Repeated rows and ids are
    packed each for itself. An empty table gives no rows. With ``special_as_text`` off, added
    tokens of the file in a text are the ids that ``tokenizers`` gives them as loaded.
    """
    with small_batches(df.sparkSession):
        rows = stored(pieces(df, id_column, text, tokenizer, capacity, special_as_text), "pieces")
    by_task = stored(rows.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "pieces")
    # One line per length: at most ``capacity`` of them.
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = plan(counts, capacity)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_task.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = rows.join(offsets, ["length", "part"]).select(
        "id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nr")).alias("number")
    )

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sequence, offset = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            length, number = batch["length"].to_numpy(), batch["number"].to_numpy()
            order = np.argsort(length, kind="stable")
            edges = np.flatnonzero(np.diff(length[order], prepend=-1))
            for a, b in zip(edges, [*edges[1:], len(order)]):
                at, s = order[a:b], int(length[order[a]])
                table = places[s]
                line = table[np.searchsorted(table[:, 0], number[at], side="right") - 1]
                inside = number[at] - line[:, 0]
                sequence[at] = line[:, 1] + inside // line[:, 2]
                offset[at] = line[:, 3] + inside % line[:, 2] * s
            yield batch.drop(columns=["number"]).assign(sequence_id=sequence, offset=offset)

    placed = numbered.mapInPandas(
        place, "id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    )
    return placed.select(F.col("id").alias(id_column), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
