"""Byte-level BPE encoding and decoding with DuckDB inside each task.

Encoding: a text is split by the vocabulary's pattern, and each distinct piece is encoded once per
task. A recursive query joins the rows (piece, position, token) with the merge table of all token
pairs whose bytes form a token, and contracts each piece's leftmost pair of minimum rank until
no pair is left; a contraction joins its two new pairs with the merge table. Pieces of more than ``SHORT`` bytes use a second query that contracts all
non-overlapping occurrences of that pair in a round, from the left, and keeps only the last
state of each piece. Both give the same tokens, because merges are numbered in the order in which
they were learned: contracting a pair never makes a pair of lower rank.

Decoding: the rows (text, position, token) of some texts at a time are joined with the vocabulary and put
together by an ordered aggregation.

There is no shuffle. The vocabulary is the only thing broadcast; its size is that of the file.
Texts are handled in slices of about ``SLICE`` characters. A Python worker remembers pieces from
task to task, at most about ``REMEMBER``; beyond that it forgets the newer half, as frequent ones
come early.

Cases: a null text counts as empty and has no tokens; strings of special tokens are ordinary text;
texts of any length are encoded whole; lone surrogates become question marks; unknown ids, and ids of
a length that is not a multiple of four bytes, decode to null; an empty table gives no rows; repeated
rows are independent, and only the columns asked for are kept.
"""

from __future__ import annotations

import base64
import hashlib
import sys
import types
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SHORT = 64
SLICE = 2_000_000
REMEMBER = 500_000
_PIECES_PER_QUERY = 40_000
_TOKENS_PER_QUERY = 100_000

_NONE = 2147483647
_ENCODE_SHORT = f"""
WITH RECURSIVE pairs AS (
  SELECT w, pos, tok, lead(tok) OVER (PARTITION BY w ORDER BY pos) AS next FROM tokens),
steps AS (
  SELECT w, list(tok ORDER BY pos) AS toks, list(coalesce(rank, {_NONE}) ORDER BY pos) AS ranks
  FROM pairs LEFT JOIN merges AS m ON tok = m.a AND next = m.b GROUP BY w
  UNION ALL
  SELECT w, list_concat(toks[:p - 1], [low], toks[p + 2:]),
    list_concat(CASE WHEN p > 1 THEN list_append(ranks[:p - 2], coalesce(l.rank, {_NONE})) ELSE [] END,
      [coalesce(r.rank, {_NONE})], ranks[p + 2:])
  FROM (
    SELECT w, toks, ranks, low, p, CASE WHEN p > 1 THEN toks[p - 1] END AS before, toks[p + 2] AS after
    FROM (SELECT w, toks, ranks, low, list_position(ranks, low) AS p
      FROM (SELECT w, toks, ranks, list_min(ranks) AS low FROM steps) WHERE low < {_NONE}))
  LEFT JOIN merges AS l ON l.a = before AND l.b = low
  LEFT JOIN merges AS r ON r.a = low AND r.b = after)
SELECT w, arg_min(toks, len(toks)) AS toks FROM steps GROUP BY w ORDER BY w
"""
_ENCODE_LONG = """
WITH RECURSIVE steps USING KEY (w) AS (
  SELECT w, list(tok ORDER BY pos) AS toks FROM tokens GROUP BY w
  UNION
  (WITH pairs AS MATERIALIZED (
    SELECT p.w, p.pos, p.tok, m.rank
    FROM (SELECT w, unnest(range(1, len(toks) + 1)) AS pos, unnest(toks) AS tok,
            unnest(list_concat(toks[2:], [NULL])) AS next FROM steps) AS p
    LEFT JOIN merges AS m ON p.tok = m.a AND p.next = m.b),
  lowest AS (SELECT w, min(rank) AS low FROM pairs WHERE rank IS NOT NULL GROUP BY w),
  found AS (
    SELECT w, pos, low, pos - row_number() OVER (PARTITION BY w ORDER BY pos) AS run
    FROM pairs JOIN lowest USING (w) WHERE rank = low),
  taken AS (
    SELECT w, pos, low FROM found
    QUALIFY row_number() OVER (PARTITION BY w, run ORDER BY pos) % 2 = 1)
  SELECT p.w, list(coalesce(t.low, p.tok) ORDER BY p.pos)
  FROM pairs AS p
  SEMI JOIN lowest USING (w)
  LEFT JOIN taken AS t ON t.w = p.w AND t.pos = p.pos
  ANTI JOIN (SELECT w, pos + 1 AS pos FROM taken) AS e ON e.w = p.w AND e.pos = p.pos
  GROUP BY p.w))
SELECT w, toks FROM steps ORDER BY w
"""
_DECODE = """
SELECT r, CASE WHEN count(v.bytes) = count(*) THEN string_agg(v.bytes, '' ORDER BY pos) END AS bytes
FROM tokens LEFT JOIN vocabulary AS v USING (id) GROUP BY r
"""


@dataclass
class Vocabulary:
    """Tokens by rank, and the pattern that splits text before merging."""

    tokens: dict[bytes, int]
    pattern: str
    merges: np.ndarray = field(init=False)
    key: str = field(init=False)

    def __post_init__(self):
        missing = [b for b in range(256) if bytes([b]) not in self.tokens]
        if missing:
            raise ValueError(f"not a byte-level vocabulary: no token for byte {missing[0]}")
        ranks = self.tokens
        pairs = [
            (ranks[token[:i]], ranks[token[i:]], rank)
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
        self.merges = np.array(pairs, np.int32).reshape(-1, 3)
        self.key = hashlib.sha256(self.merges.tobytes() + repr((sorted(ranks.items()), self.pattern)).encode()).hexdigest()

    @classmethod
    def load(cls, path: str, pattern: str) -> Vocabulary:
        with open(path, "rb") as lines:
            cells = [line.split() for line in lines if line.strip()]
        return cls({base64.b64decode(token): int(rank) for token, rank in cells}, pattern)


def _connection() -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET threads = 1")
    return con


def _trim(known: dict) -> None:
    if len(known) > REMEMBER:
        for item in list(known)[REMEMBER // 2 :]:
            del known[item]


def _kept(kind: type, vocabulary: Vocabulary):
    """The worker's own encoder or decoder, which outlives its tasks."""
    held = sys.modules.setdefault("logloom_worker", types.ModuleType("logloom_worker")).__dict__
    name = f"{kind.__name__}-{vocabulary.key}"
    if name not in held:
        held[name] = kind(vocabulary)
    return held[name]


def _rows(items: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Item number, position and value of the fixed-width values in ``items``."""
    lengths = np.array([len(x) // width for x in items], np.int64)
    item = np.repeat(np.arange(len(items), dtype=np.int32), lengths)
    place = np.arange(len(item)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return item, place.astype(np.int32), np.frombuffer(b"".join(items), np.uint8 if width == 1 else "<u4")


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.split = regex.compile(vocabulary.pattern)
        self.of_byte = np.array([vocabulary.tokens[bytes([b])] for b in range(256)], np.int32)
        self.known: dict[str, bytes] = {}
        self.con = _connection()
        a, b, rank = vocabulary.merges.T
        self.con.register("given", pa.table({"a": a, "b": b, "rank": rank}))
        self.con.execute("CREATE TABLE merges AS SELECT * FROM given")

    def _query(self, pieces: list[bytes], sql: str) -> list[bytes]:
        item, place, byte = _rows(pieces, 1)
        self.con.register("tokens", pa.table({"w": item, "pos": place, "tok": self.of_byte[byte]}))
        toks = self.con.sql(sql).to_arrow_table()["toks"].combine_chunks()
        values = toks.values.to_numpy(zero_copy_only=False).astype("<u4").tobytes()
        ends = toks.offsets.to_numpy() * 4
        return [values[i:j] for i, j in zip(ends[:-1], ends[1:], strict=True)]

    def learn(self, pieces: set[str]) -> None:
        """Encode the pieces that are not known yet."""
        todo = list(pieces.difference(self.known))
        for at in range(0, len(todo), _PIECES_PER_QUERY):
            some = todo[at : at + _PIECES_PER_QUERY]
            data = [p.encode("utf-8", "replace") for p in some]
            for sql, wanted in ((_ENCODE_SHORT, lambda n: n <= SHORT), (_ENCODE_LONG, lambda n: n > SHORT)):
                chosen = [i for i, d in enumerate(data) if wanted(len(d))]
                if chosen:
                    found = self._query([data[i] for i in chosen], sql)
                    self.known.update((some[i], ids) for i, ids in zip(chosen, found, strict=True))

    def _pieces(self, text: str) -> Iterator[list[str]]:
        if len(text) <= 2 * SLICE:
            yield self.split.findall(text)
            return
        found = self.split.finditer(text)
        while part := [m.group() for m in islice(found, SLICE // 4)]:
            yield part

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        _trim(self.known)
        out = []
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end] or "") <= SLICE):
                size += len(texts[end] or "")
                end += 1
            if end - at == 1:
                parts = []
                for pieces in self._pieces(texts[at] or ""):
                    self.learn(set(pieces))
                    parts.append(b"".join(map(self.known.__getitem__, pieces)))
                out.append(b"".join(parts))
            else:
                split = [self.split.findall(t or "") for t in texts[at:end]]
                self.learn(set().union(*split))
                out += [b"".join(map(self.known.__getitem__, pieces)) for pieces in split]
            at = end
        return out


class Decoder:
    def __init__(self, vocabulary: Vocabulary):
        self.con = _connection()
        # A token is a text of one character per byte, so that texts can be put together.
        table = {"id": pa.array(list(vocabulary.tokens.values()), pa.uint32()), "bytes": [t.decode("latin-1") for t in vocabulary.tokens]}
        self.con.register("given", pa.table(table))
        self.con.execute("CREATE TABLE vocabulary AS SELECT * FROM given")

    def _query(self, ids: list[bytes]) -> dict[int, bytes | None]:
        item, place, token = _rows(ids, 4)
        self.con.register("tokens", pa.table({"r": item, "pos": place, "id": token}))
        return {r: None if text is None else text.encode("latin-1") for r, text in self.con.sql(_DECODE).fetchall()}

    def decode(self, ids: list[bytes | None]) -> list[bytes | None]:
        """The bytes of each id sequence; null if it holds an id that is no token."""
        out: list[bytes | None] = [b"" if x is not None and len(x) % 4 == 0 else None for x in ids]
        todo = [i for i, x in enumerate(ids) if x and out[i] is not None]
        while todo:
            # As many sequences as have _TOKENS_PER_QUERY tokens, one at least.
            sizes = np.cumsum([len(ids[i]) // 4 for i in todo])
            n = max(1, int(np.searchsorted(sizes, _TOKENS_PER_QUERY, "right")))
            some, todo = todo[:n], todo[n:]
            for r, data in self._query([ids[i] for i in some]).items():
                out[some[r]] = data
        return out


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``SLICE`` bytes of the column, at least one row each."""
    sizes = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy())
    at = 0
    while at < batch.num_rows:
        used = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, used + SLICE, "right")))
        yield batch.slice(at, end - at)
        at = end


def _run(df: DataFrame, column: str, keep: list[str], vocabulary: Vocabulary, encoding: bool, decoding: bool) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)
    out = [T.StructField("ids", T.BinaryType())] * encoding + [T.StructField("decoded", T.BinaryType())] * decoding
    rows = df.select(df[column].alias("_in"), *[df[c] for c in keep])
    schema = T.StructType([*rows.schema.fields[1:], *out])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _kept(Encoder, shared.value) if encoding else None
        decoder = _kept(Decoder, shared.value) if decoding else None
        for batch in batches:
            for part in _slices(batch, 0):
                found, made = part.column(0).to_pylist(), []
                if encoder:
                    found = encoder.encode(found)
                    made.append(pa.array(found, pa.binary()))
                if decoder:
                    made.append(pa.array(decoder.decode(found), pa.binary()))
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *made], schema.names)

    return rows.mapInArrow(work, schema)


def encode(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` and ``ids``: the tokens of the text, four bytes each."""
    return _run(docs, text_col, keep or [], vocabulary, True, False)


def decode(rows: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` and ``decoded``: the bytes of the tokens."""
    return _run(rows, ids_col, keep or [], vocabulary, False, True)


def round_trip(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """:func:`encode` and :func:`decode` in one pass: ``keep``, ``ids``, ``decoded``."""
    return _run(docs, text_col, keep or [], vocabulary, True, True)
