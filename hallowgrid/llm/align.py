"""Links between the tokens of two vocabularies over the same record texts, by sparse row products."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import reliable_checkpoint
from .bpe import WORDS, byte_letters

#: Bytes of text that are aligned together; a longer text is a chunk of its own.
CHUNK = 16 << 20
BLOCK = 4 << 20
#: Bytes a record costs in a chunk besides its text.
ROW = 64
#: Entries that one step of a product spreads out at once, beyond a single row.
SPREAD = 1 << 20
#: Space that begins a word piece.
MARK = "▁"

GROUPS = "row_ord long, a_ids array<int>, b_ids array<int>, groups array<struct<a array<int>, b array<int>>>"
DIGESTS = "row_ord long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


# --- Sparse matrices -------------------------------------------------------------------
@dataclass
class Csr:
    """Compressed rows: the columns of row i are ``cols[ptr[i]:ptr[i + 1]]``, with ``vals`` beside them."""

    ptr: np.ndarray
    cols: np.ndarray
    vals: np.ndarray

    @classmethod
    def of(cls, rows: np.ndarray, cols: np.ndarray, vals: np.ndarray, n_rows: int, n_cols: int) -> Csr:
        """Entries in any order; equal places are added up."""
        key = rows.astype(np.int64) * n_cols + cols
        if key.size and (key[1:] < key[:-1]).any():
            order = np.argsort(key, kind="stable")
            key, vals = key[order], vals[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if key.size else np.empty(0, np.int64)
        key, vals = key[first], np.add.reduceat(vals, first) if key.size else vals
        return cls(np.r_[0, np.cumsum(np.bincount(key // n_cols, minlength=n_rows))], key % n_cols, vals)

    def owners(self) -> np.ndarray:
        """Row of each entry."""
        return np.repeat(np.arange(self.ptr.size - 1), np.diff(self.ptr))


def _spread(starts: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i] + 1, ...`` for ``widths[i]`` places, one i after another."""
    return np.repeat(starts - np.r_[0, np.cumsum(widths)[:-1]], widths) + np.arange(widths.sum())


def products(a: Csr, b: Csr, n_cols: int) -> Iterator[tuple[int, Csr]]:
    """Row products by Gustavson: row i of a times b is the sum of the rows of b that row i of a names.

    Yields blocks of consecutive rows with the number of the first; a block spreads out ``SPREAD`` entries at most
    unless it is a single row.
    """
    n = a.ptr.size - 1
    widths = b.ptr[a.cols + 1] - b.ptr[a.cols]
    reach = np.r_[0, np.cumsum(widths)][a.ptr]
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(reach, reach[lo] + SPREAD, "right")) - 1)
        own = slice(a.ptr[lo], a.ptr[hi])
        w = widths[own]
        at = _spread(b.ptr[a.cols[own]], w)
        rows = np.repeat(np.repeat(np.arange(hi - lo), np.diff(a.ptr[lo : hi + 1])), w)
        yield lo, Csr.of(rows, b.cols[at], np.repeat(a.vals[own], w) * b.vals[at], hi - lo, n_cols)
        lo = hi


def _entries(a: Csr, b: Csr, n_cols: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All entries of a product: rows, columns, values."""
    found = [(lo + c.owners(), c.cols, c.vals) for lo, c in products(a, b, n_cols)]
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 3


def _incidence(sizes: np.ndarray) -> Csr:
    """Tokens by bytes: every token meets the bytes it covers."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if ends.size else 0
    return Csr(np.r_[0, ends], np.arange(total), np.ones(total, np.int64))


def _transposed(sizes: np.ndarray) -> Csr:
    """Bytes by tokens: every byte lies in one token."""
    total = int(sizes.sum())
    return Csr(np.arange(total + 1), np.repeat(np.arange(sizes.size), sizes), np.ones(total, np.int64))


def groups_of(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group of each token of two sequences that cover the same bytes.

    A times B transposed gives the overlapping tokens; a group ends with a link whose tokens end at the same byte.
    """
    i, j, _ = _entries(_incidence(a_sizes), _transposed(b_sizes), max(1, b_sizes.size))
    cut = np.cumsum(a_sizes)[i] == np.cumsum(b_sizes)[j]
    nth = np.cumsum(cut) - cut
    a, b = np.zeros(a_sizes.size, np.int64), np.zeros(b_sizes.size, np.int64)
    a[i], b[j] = nth, nth
    return a, b


def shared_links(a_groups, a_ids, b_groups, b_ids) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``group, a id, b id, times`` of all links between tokens of one group.

    Equal ids of a group are one row (A) or column (B) of the incidence matrices, their number is its value; the
    product of A's incidence with B's transposed counts the links.
    """
    n = int(a_groups[-1]) + 1 if a_groups.size else 0

    def rows(groups, ids):
        key, times = np.unique(groups << 32 | ids, return_counts=True)
        return key >> 32, key & 0xFFFFFFFF, times

    ga, ia, ta = rows(a_groups, a_ids)
    gb, ib, tb = rows(b_groups, b_ids)
    left = Csr(np.arange(ga.size + 1), ga, ta)
    right = Csr(np.r_[0, np.cumsum(np.bincount(gb, minlength=n))], np.arange(gb.size), tb)
    i, j, times = _entries(left, right, max(1, gb.size))
    return ga[i], ia[i], ib[j], times


# --- Texts -----------------------------------------------------------------------------
#: Blanks other than space and line feed; what one library takes for a blank another may not.
ODD = re.compile(r"[^\S \n]|[\x1c-\x1f᠎​﻿]")
#: One of these bytes is in the UTF-8 form of each such character.
ODD_BYTES = bytes([0x09, *range(0x0B, 0x0E), *range(0x1C, 0x20), 0xC2, 0xE1, 0xE2, 0xE3, 0xEF])
UNITS = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
#: The same, cut only before a space or line feed that follows a character no library takes for a blank.
ODD_UNITS = re.compile(r"(?s).+?(?:(?<=[^\s\x1c-\x1f᠎​﻿])(?=[ \n])|\Z)")


#: Texts that libraries of different age cut alike: no blank but space and line feed, letters long known; not blank at the end.
PLAIN = re.compile(r"[ -~\n\u00a1-\u024f]*[!-~\u00a1-\u024f]")


class Pair:
    """Both vocabularies, and what has been found for units of text.

    A has no token that goes on from a character into a space or line feed.  Where B has none either, texts are cut
    there, and the units are encoded, linked and remembered by themselves; else a text is one unit.  ``written`` also
    keeps the groups of a unit as text.
    """

    def __init__(self, byte_level: str, pieces: bytes, written: bool = True, most: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_str(byte_level)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        back = {c: b for b, c in byte_letters().items()}
        words = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.a_bytes = [bytes(map(back.__getitem__, w)) if all(c in back for c in w) else w.encode() for w in words]
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        whole = re.compile(rf"[{MARK} \n]*[^{MARK} \n]*")
        self.cuts = all(whole.fullmatch(self.b.id_to_piece(i)) for i in range(len(self.b_bytes)) if not self.b.is_byte(i))
        self.a_sizes = np.array([len(w) for w in self.a_bytes])
        self.b_sizes = np.array([len(w) for w in self.b_bytes])
        self.blank = self.b.piece_to_id(MARK)
        #: Each id as text with the mark that follows it: within a group, after its A tokens, after its B tokens.
        self.labels = [f"{i}{m}" for i in range(max(len(self.a_bytes), len(self.b_bytes))) for m in ",|;"]
        self.fast = self._ranked(json.loads(byte_level))
        self.written, self.most = written, most
        self._forget()

    def _piece(self, i: int) -> bytes:
        p = self.b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode()

    def _ranked(self, spec: dict):
        """A faster encoder of plain units, where ids follow the ranks of the merges and words the usual pattern."""
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        merged = [model["vocab"].get("".join(m.split(" ") if isinstance(m, str) else m), -1) for m in model["merges"]]
        usual = before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
        if not usual or spec.get("normalizer") or any(x >= y for x, y in zip(merged, merged[1:])):
            return None
        import tiktoken

        added = {t["id"] for t in spec.get("added_tokens", [])}
        ranks = {self.a_bytes[i]: i for i in model["vocab"].values() if i not in added}
        return tiktoken.Encoding("plain", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def _forget(self) -> None:
        """Number of each known unit (-1 where its tokens do not spell it); by number: groups as text, counts, links."""
        self.seen: dict[str, int] = {}
        self.texts: list[str] = []
        self.counts = np.empty((0, 4), np.int64)
        self.links = Csr(np.zeros(1, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))

    def _keep(self, units: set[str]) -> None:
        """Forget all other units."""
        units = [u for u in units if self.seen[u] >= 0]
        own = np.fromiter(map(self.seen.__getitem__, units), np.int64, len(units))
        texts, counts, links = self.texts, self.counts, self.links
        self._forget()
        widths = np.diff(links.ptr)[own]
        at = _spread(links.ptr[own], widths)
        self.seen = dict(zip(units, range(len(units))))
        self.texts = list(map(texts.__getitem__, own.tolist())) if self.written else []
        self.counts, self.links = counts[own], Csr(np.r_[0, np.cumsum(widths)], links.cols[at], links.vals[at])

    def units(self, text: str | None) -> list[str]:
        """A space and the text, cut into units; none for a null or empty text."""
        if not text:
            return []
        text = " " + text
        if not self.cuts:
            return [text]
        raw = text.encode()
        odd = len(raw.translate(None, ODD_BYTES)) < len(raw) and ODD.search(text)
        return (ODD_UNITS if odd else UNITS).findall(text)

    def _b_ids(self, units: list[str]) -> list[list[int]]:
        """Pieces of units.  The model puts a space first: it stands for a unit's own one or is dropped again."""
        found = self.b.encode([u[1:] if u[0] == " " else u for u in units], num_threads=1)
        return [(ids if len(u) > 1 else [self.blank]) if u[0] == " " else ids[1:] for u, ids in zip(units, found)]

    def _encoded(self, units: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Units, plain ones first, with the ids of all and their numbers for A and B; those not spelled are noted and left out."""
        plain = [u for u in units if PLAIN.fullmatch(u)] if self.fast else []
        one_by_one = set(units).difference(plain)
        units = [*plain, *one_by_one]
        # A blank begins each plain unit and none ends with one, so that together they are cut as they are alone.
        together = np.array(self.fast.encode_ordinary("".join(plain)), np.int64) if plain else np.empty(0, np.int64)
        alone = [e.ids for e in self.a.encode_batch_fast([*one_by_one], add_special_tokens=False)]
        pieces = self._b_ids(units)
        spelled = [u.encode() for u in units]
        size = np.array([len(u) for u in spelled])
        ends = np.searchsorted(np.cumsum(self.a_sizes[together]), np.cumsum(size[: len(plain)]), "right")
        n_a = np.r_[np.diff(np.r_[0, ends]), [len(x) for x in alone]].astype(np.int64)
        n_b = np.array([len(x) for x in pieces], np.int64)
        a = np.r_[together, np.fromiter(chain.from_iterable(alone), np.int64)]
        b = np.fromiter(chain.from_iterable(pieces), np.int64)

        def right(ids, n, sizes, strings):
            """Units whose tokens spell them."""
            ends = np.cumsum(n)
            total = np.r_[0, np.cumsum(sizes[ids])]
            same = total[ends] - total[ends - n] == size
            parts = list(map(strings.__getitem__, ids.tolist()))
            if not same.all() or b"".join(parts) != b"".join(spelled):
                same = np.array([b"".join(parts[e - k : e]) == u for e, k, u in zip(ends.tolist(), n.tolist(), spelled)], bool)
            return same

        fine = right(a, n_a, self.a_sizes, self.a_bytes) & right(b, n_b, self.b_sizes, self.b_bytes)
        if not fine.all():
            self.seen.update((units[k], -1) for k in np.flatnonzero(~fine).tolist())
            a, b = a[np.repeat(fine, n_a)], b[np.repeat(fine, n_b)]
            units, n_a, n_b = [units[k] for k in np.flatnonzero(fine).tolist()], n_a[fine], n_b[fine]
        return units, a, n_a, b, n_b

    def learn(self, units: list[str]) -> None:
        """Encode and link units, and remember them."""
        units, a, n_a, b, n_b = self._encoded(units)
        if not units:
            return
        ga, gb = groups_of(self.a_sizes[a], self.b_sizes[b])
        last = ga[np.cumsum(n_a) - 1]
        group, left, right, times = shared_links(ga, a, gb, b)
        owner = np.searchsorted(last, group)
        code, ptr = left << 32 | right, np.cumsum(np.bincount(owner, minlength=len(units)))
        n_links = np.add.reduceat(times, np.r_[0, ptr[:-1]])
        known = len(self.counts)
        self.seen.update(zip(units, range(known, known + len(units))))
        self.texts += self._texts(a, ga, b, gb, n_a + n_b) if self.written else []
        self.counts = np.r_[self.counts, np.c_[n_a, n_b, np.diff(np.r_[-1, last]), n_links]]
        links = self.links
        self.links = Csr(np.r_[links.ptr, links.ptr[-1] + ptr], np.r_[links.cols, code], np.r_[links.vals, times])

    def _texts(self, a, ga, b, gb, sizes) -> list[str]:
        """The groups of each unit: all tokens in the order of the groups, A before B, each with the mark that follows it."""
        ends_a, ends_b = (np.r_[g[1:] != g[:-1], True].astype(np.int64) for g in (ga, gb))
        order = np.argsort(np.r_[2 * ga, 2 * gb + 1], kind="stable")
        parts = list(map(self.labels.__getitem__, np.r_[3 * a + ends_a, 3 * b + 2 * ends_b][order].tolist()))
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))[np.cumsum(sizes) - 1].tolist()
        whole = "".join(parts)
        return [whole[i : k - 1] for i, k in zip([0, *ends[:-1]], ends)]

    def block(self, texts: list[str | None]) -> Block:
        found = [self.units(t) for t in texts]
        wanted = set().union(*found)
        if len(self.seen) + len(wanted.difference(self.seen)) > self.most:
            self._keep(wanted.intersection(self.seen))
        new = list(wanted.difference(self.seen))
        for k in range(0, len(new), 100_000):
            self.learn(new[k : k + 100_000])
        return Block(self, found)


class Block:
    """Texts by units and units by links, as sparse matrices over this block's units and pairs of ids."""

    def __init__(self, pair: Pair, found: list[list[str]]):
        sizes = [len(us) for us in found]
        flat = np.fromiter(map(pair.seen.__getitem__, chain.from_iterable(found)), np.int64, sum(sizes))
        owner = np.repeat(np.arange(len(found)), sizes)
        spelled = np.ones(len(found), bool)
        spelled[owner[flat < 0]] = False
        flat, owner = flat[spelled[owner]], owner[spelled[owner]]
        cut = np.cumsum(np.bincount(owner, minlength=len(found))) if found else []
        #: Numbers of the units of each text, none where it is not spelled by its tokens.
        self.units = np.split(flat, cut[:-1]) if len(found) else []
        self.texts = pair.texts
        known = np.zeros(len(pair.counts), bool)
        known[flat] = True
        used, at = np.flatnonzero(known), (np.cumsum(known) - 1)[flat]
        self.counts = pair.counts[used]
        widths = np.diff(pair.links.ptr)[used]
        own = _spread(pair.links.ptr[used], widths)
        #: Pairs of ids linked in this block, as A's id shifted by 32 bits with B's.
        self.pairs, cols = np.unique(pair.links.cols[own], return_inverse=True)
        self.links = Csr(np.r_[0, np.cumsum(widths)], cols, pair.links.vals[own])
        self.owner, self.held = owner, Csr(np.r_[0, cut].astype(np.int64), at, np.ones(at.size, np.int64))

    def groups(self, k: int) -> str:
        return ";".join(map(self.texts.__getitem__, self.units[k].tolist()))

    def texts_per_pair(self) -> np.ndarray:
        """In how many texts each of ``pairs`` is linked: texts by units times units by pairs, each entry once."""
        out, held = np.zeros(self.pairs.size, np.int64), self.held
        once = Csr.of(self.owner, held.cols, held.vals, held.ptr.size - 1, max(1, len(self.counts)))
        for _, c in products(once, self.links, max(1, self.pairs.size)):
            out += np.bincount(c.cols, minlength=self.pairs.size)
        return out

    def sums(self, by_pair: np.ndarray) -> np.ndarray:
        """Counts of each text, then its links' sums of the columns of ``by_pair``."""

        def summed(rows: Csr, values: np.ndarray) -> np.ndarray:
            out = np.empty((rows.ptr.size - 1, values.shape[1]), np.int64)
            for k in range(values.shape[1]):
                total = np.r_[0, np.cumsum(values[rows.cols, k] * rows.vals)]
                out[:, k] = total[rows.ptr[1:]] - total[rows.ptr[:-1]]
            return out

        return summed(self.held, np.c_[self.counts, summed(self.links, by_pair)])


#: One pair of vocabularies in a worker, so that its memory of units lasts over tasks.
_PAIRS: dict[tuple, Pair] = {}


def _pair_of(sent, written: bool = True) -> Pair:
    byte_level, pieces = sent.value
    name = hashlib.sha256(byte_level.encode() + pieces).hexdigest(), written
    if name not in _PAIRS:
        _PAIRS.clear()
        _PAIRS[name] = Pair(byte_level, pieces, written)
    return _PAIRS[name]


def _sent(records: DataFrame, byte_level: str, pieces: str):
    """Both vocabulary files (a few MB whatever the records are), read once and sent to the executors."""
    with open(byte_level, encoding="utf-8") as a, open(pieces, "rb") as b:
        return records.sparkSession.sparkContext.broadcast((a.read(), b.read()))


def _blocks(texts: Iterable[str | None], most: int = BLOCK) -> Iterator[list[str | None]]:
    block, size = [], 0
    for t in texts:
        size += ROW + len(t or "")
        if block and size > most:
            yield block
            block, size = [], ROW + len(t or "")
        block.append(t)
    if block:
        yield block


def _chunked(batches):
    """Number the chunks of a task; the table is written, so that they stay."""
    part, chunk, size = TaskContext.get().partitionId(), 0, 0
    for b in batches:
        out = []
        for n in pc.fill_null(pc.binary_length(b.column(1)), 0).to_pylist():
            if size and size + ROW + n > CHUNK:
                chunk, size = chunk + 1, 0
            size += ROW + n
            out.append(part << 32 | chunk)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.int64())], ["row_ord", "desc", "chunk"])


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, at = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
    return codes, np.bincount(at, np.concatenate([n for _, n in held]), codes.size).astype(np.int64)


def _texts_per_pair(sent):
    def run(batches):
        pair, chunk, held = _pair_of(sent, written=False), None, []

        def done():
            if held:
                codes, n = _merged(held)
                for k in range(0, codes.size, 100_000):
                    own = slice(k, k + 100_000)
                    where = pa.array(np.full(codes[own].size, chunk), pa.int64())
                    yield pa.RecordBatch.from_arrays([where, pa.array(codes[own]), pa.array(n[own])], ["chunk", "pair", "n"])

        for b in batches:
            chunks = b.column(2).to_numpy()
            cut = np.flatnonzero(np.r_[True, chunks[1:] != chunks[:-1]]).tolist() if chunks.size else []
            for lo, hi in zip(cut, [*cut[1:], chunks.size]):
                if chunks[lo] != chunk:
                    yield from done()
                    chunk, held = int(chunks[lo]), []
                for texts in _blocks(t.as_py() for t in b.column(1).slice(lo, hi - lo)):
                    block = pair.block(texts)
                    held.append((block.pairs, block.texts_per_pair()))
                held = [_merged(held)] if len(held) > 8 else held
        yield from done()

    return run


def _given(records: DataFrame, key: str, body: str) -> DataFrame:
    return records.select(F.col(key).cast("long").alias("row_ord"), F.col(body).alias("desc"))


def _counted(records: DataFrame, sent, key: str, body: str) -> tuple[DataFrame, DataFrame]:
    """Texts with their chunk, and for each chunk the pairs linked in it with the number of its texts."""
    spark = records.sparkSession
    texts = reliable_checkpoint(spark, _given(records, key, body).mapInArrow(_chunked, "row_ord long, desc string, chunk long"))
    return texts, reliable_checkpoint(spark, texts.mapInArrow(_texts_per_pair(sent), "chunk long, pair long, n long"))


def link_counts(records: DataFrame, byte_level: str, pieces: str, key: str = "row_ord", body: str = "desc") -> DataFrame:
    """``a_id, b_id, n``: in how many records an id of each vocabulary are linked, see :func:`align_records`."""
    _, found = _counted(records, _sent(records, byte_level, pieces), key, body)
    ids = F.shiftright("pair", 32).cast("int").alias("a_id"), F.col("pair").bitwiseAND(0xFFFFFFFF).cast("int").alias("b_id")
    return found.groupBy("pair").agg(F.sum("n").alias("n")).select(*ids, "n")


def aligned_groups(records: DataFrame, byte_level: str, pieces: str, key: str = "row_ord", body: str = "desc") -> DataFrame:
    """``row_ord, a_ids, b_ids, groups``: the token ids of each record text in both vocabularies, and their groups.

    ``groups`` holds the ids of each group in order; edge cases as in :func:`align_records`.  No data moves.
    """
    sent = _sent(records, byte_level, pieces)

    def run(batches):
        pair = _pair_of(sent)
        for b in batches:
            keys = iter(b.column(0).to_pylist())
            for texts in _blocks(t.as_py() for t in b.column(1)):
                block, rows = pair.block(texts), []
                for k in range(len(texts)):
                    cut = [tuple(list(map(int, s.split(","))) for s in g.split("|")) for g in block.groups(k).split(";") if g]
                    rows.append({"row_ord": next(keys), "a_ids": [i for a, _ in cut for i in a], "b_ids": [i for _, x in cut for i in x], "groups": [{"a": a, "b": x} for a, x in cut]})
                ids = pa.list_(pa.int32())
                yield pa.RecordBatch.from_pylist(rows, pa.schema([("row_ord", pa.int64()), ("a_ids", ids), ("b_ids", ids), ("groups", pa.list_(pa.struct([("a", ids), ("b", ids)])))]))

    return _given(records, key, body).mapInArrow(run, GROUPS)


def _digests(sent):
    def run(key, texts: pa.Table, met: pa.Table) -> pa.Table:
        pair = _pair_of(sent)
        known = met.sort_by("pair")
        codes = known.column("pair").to_numpy()
        values = np.c_[known.column("best").to_numpy().astype(np.int64), known.column("count").to_numpy()]
        sums, shas = [np.empty((0, 6), np.int64)], []
        for part in _blocks(t.as_py() for t in texts.column("desc")):
            block = pair.block(part)
            sums.append(block.sums(values[np.searchsorted(codes, block.pairs)].reshape(-1, 2)))
            shas += [hashlib.sha256(block.groups(k).encode()).hexdigest() if us.size else "" for k, us in enumerate(block.units)]
        sums = np.concatenate(sums)
        names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
        return pa.table({"row_ord": texts.column("row_ord"), **{c: sums[:, k] for k, c in enumerate(names)}, "groups_sha256": pa.array(shas, pa.string())})

    return run


def align_records(records: DataFrame, byte_level: str, pieces: str, key: str = "row_ord", body: str = "desc") -> DataFrame:
    """How the tokens of two vocabularies cover each record text.

    ``records`` are decision records (``row_ord``, ``desc``); ``byte_level`` (A) is the path of a byte-level BPE file of
    the ``tokenizers`` library, ``pieces`` (B) of a ``sentencepiece`` model, which begins texts with a space; A reads a
    space and the text.  Special tokens are plain text.  Places where tokens of both end cut them into groups, and all
    A and B tokens of a group are linked.  A pair of ids counts the records that hold it linked, over all records.

    Returns ``row_ord, n_a, n_b, n_groups, n_links`` (tokens, groups, links), ``n_best`` (links whose count is the
    highest of their A id, ties included), ``count_sum`` (of the links' counts) and ``groups_sha256`` (lowercase hex of
    ``a1,a2|b1;a3|b2,b3``), one row per input row; :func:`aligned_groups` has the groups themselves.

    A text that is null or empty, or whose tokens do not spell its bytes (word pieces cannot tell U+2581 from a space),
    has no tokens: zeros and an empty ``groups_sha256``.  Null keys are carried; repeated rows stay repeated and count
    each; an empty table gives no rows; other columns are ignored.  Texts of any length are read whole; a unit without
    blanks whose tokens never end together costs the product of its distinct ids.

    Texts are written once with a chunk number.  Links are counted per chunk, added up over chunks, and go back to
    the chunks that hold them, so what moves besides the texts is each chunk's distinct pairs.
    """
    sent = _sent(records, byte_level, pieces)
    texts, found = _counted(records, sent, key, body)
    total = found.groupBy("pair").agg(F.sum("n").alias("count"))
    of_a = Window.partitionBy(F.shiftright("pair", 32))  # at most one row for each id of B
    known = total.select("pair", "count", (F.max("count").over(of_a) == F.col("count")).alias("best"))
    met = found.select("chunk", "pair").distinct().join(known, "pair")
    return texts.groupBy("chunk").cogroup(met.groupBy("chunk")).applyInArrow(_digests(sent), DIGESTS)
