"""Byte-level BPE of record texts: merges by a priority queue over linked symbols, decoding by concatenation."""

from __future__ import annotations

import hashlib
import heapq
import json
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .memo import Remembered

#: Fixed values of the public byte-level format: its word pattern, and the bytes that stand for themselves.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Letters and numbers that the public library's Unicode tables do not know yet; it takes them for symbols.
NEWER = (
    r"\u0558\u058b\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1\uab6c\uab6d"
    r"\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a"
    r"\U00011db0-\U00011ddb\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686"
    r"\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda"
    r"\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128"
    r"\U0001b168\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff"
    r"\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2\U0001e6e4\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4"
    r"\U0001e6fe\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f"
)
OLDER_WORDS = rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d| ?[\p{{L}}--[{NEWER}]]+| ?[\p{{N}}--[{NEWER}]]+| ?[^\s[\p{{L}}\p{{N}}--[{NEWER}]]]+|\s+(?!\S)|\s+"
PRINTABLE = (range(0x21, 0x7F), range(0xA1, 0xAD), range(0xAE, 0x100))

SCHEMA = "row_ord long, ids array<int>, decoded string"
DIGESTS = "row_ord long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_letters() -> dict[int, str]:
    """Letter that stands for each byte in the vocabulary: itself if printable, else the next one above 255."""
    own = {b for r in PRINTABLE for b in r}
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Codec:
    """Encoder and decoder of one vocabulary file's text."""

    def __init__(self, vocabulary: str, remember: int = 300_000):
        spec = json.loads(vocabulary)
        ids, letters = spec["model"]["vocab"], byte_letters()
        back = {c: b for b, c in letters.items()}
        self.start = [ids[letters[b]] for b in range(256)]
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[ids[left] << 32 | ids[right]] = (rank, ids[left + right])
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.pieces = {i: bytes(back[c] for c in w) for w, i in ids.items() if all(c in back for c in w)}
        self.pieces |= {i: w.encode() for w, i in self.special.items()}
        marks = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("|".join(map(regex.escape, marks))) if marks else None
        self.newer = regex.compile(f"[{NEWER}]")
        self.words, self.older_words = regex.compile(WORDS), regex.compile(OLDER_WORDS)
        self.seen = Remembered(lambda w: b"".join(i.to_bytes(4, "little") for i in self.merge(w)), remember)

    def merge(self, word: str) -> list[int]:
        """Ids of one word.

        Symbols form a doubly linked list; the queue holds adjacent pairs by rank, then place.  An entry is stale
        when its left symbol is gone or the pair there now has another rank; it is skipped.
        """
        symbols = [self.start[b] for b in word.encode("utf-8")]
        n, merges = len(symbols), self.merges
        if n < 2:
            return symbols
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        queue = [
            found[0] * n + i
            for i in range(n - 1)
            if (found := merges.get(symbols[i] << 32 | symbols[i + 1])) is not None
        ]
        heapq.heapify(queue)
        while queue:
            rank, left = divmod(heapq.heappop(queue), n)
            right = after[left]
            if symbols[left] < 0 or right < 0:
                continue
            found = merges.get(symbols[left] << 32 | symbols[right])
            if found is None or found[0] != rank:
                continue
            symbols[left], symbols[right] = found[1], -1
            beyond = after[left] = after[right]
            if beyond >= 0:
                before[beyond] = left
                if (found := merges.get(symbols[left] << 32 | symbols[beyond])) is not None:
                    heapq.heappush(queue, found[0] * n + left)
            ahead = before[left]
            if ahead >= 0 and (found := merges.get(symbols[ahead] << 32 | symbols[left])) is not None:
                heapq.heappush(queue, found[0] * n + ahead)
        return [s for s in symbols if s >= 0]

    def packed(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if self.cut is None or self.cut.search(text) is None:
            return self._plain(text)
        out, at = [], 0
        for m in self.cut.finditer(text):
            out += [self._plain(text[at : m.start()]), self.special[m[0]].to_bytes(4, "little")]
            at = m.end()
        return b"".join([*out, self._plain(text[at:])])

    def _plain(self, text: str) -> bytes:
        words = self.words if text.isascii() or self.newer.search(text) is None else self.older_words
        return b"".join(map(self.seen.__getitem__, words.findall(text)))

    def encode(self, text: str) -> array:
        ids = array("I")
        ids.frombytes(self.packed(text))
        return ids

    def decode(self, ids) -> str:
        """Vocabulary strings end to end, as UTF-8; broken sequences become replacement characters."""
        return b"".join(map(self.pieces.__getitem__, ids)).decode("utf-8", "replace")


#: One codec per vocabulary in a worker, so that its memory of words lasts over tasks.
_CODECS: dict[str, Codec] = {}


def codec_of(vocabulary: str) -> Codec:
    name = hashlib.sha256(vocabulary.encode()).hexdigest()
    if name not in _CODECS:
        _CODECS.clear()
        _CODECS[name] = Codec(vocabulary)
    return _CODECS[name]


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[int | None, str]]:
    for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
        yield key, text.as_py() or ""


def _vocabulary(records: DataFrame, path: str):
    """The vocabulary file's text (a few MB whatever the records are), read once and sent to the executors."""
    with open(path, encoding="utf-8") as f:
        return records.sparkSession.sparkContext.broadcast(f.read())


def encode_records(records: DataFrame, vocabulary: str, body: str = "desc", key: str = "row_ord") -> DataFrame:
    """Token ids of every record text, and the text they decode to.

    ``records`` are decision records (``row_ord``, ``desc``); ``vocabulary`` is the path of a byte-level BPE file of
    the ``tokenizers`` library, whose special tokens are recognised inside a text as that library does.

    Returns ``row_ord, ids array<int>, decoded``, one row per input row.  A null or empty text has no ids and decodes
    to the empty text; a null key stays null; repeated rows stay repeated; an empty table gives no rows; other columns
    are ignored.  A text of any length is encoded whole; one word costs n log n in its length.  No data moves between
    tasks.
    """
    sent = _vocabulary(records, vocabulary)

    def run(batches):
        codec = codec_of(sent.value)
        for batch in batches:
            for key_, text in _rows(batch):
                ids = codec.encode(text)
                yield pa.RecordBatch.from_pydict({"row_ord": pa.array([key_], pa.int64()), "ids": pa.array([ids.tolist()], pa.list_(pa.int32())), "decoded": pa.array([codec.decode(ids)], pa.string())})

    return records.select(F.col(key).cast("long").alias("row_ord"), F.col(body).alias("desc")).mapInArrow(run, SCHEMA)


def token_digests(records: DataFrame, vocabulary: str, body: str = "desc", key: str = "row_ord") -> DataFrame:
    """As :func:`encode_records`, but only the number of ids and digests of ids and decoded text leave a task.

    Returns ``row_ord, n_tokens, ids_sha256, decoded_sha256``: lowercase hex of the ids as little-endian unsigned
    32-bit integers, and of the decoded text in UTF-8.  Edge cases as above.
    """
    sent = _vocabulary(records, vocabulary)

    def run(batches):
        codec = codec_of(sent.value)
        for batch in batches:
            out = []
            for key_, text in _rows(batch):
                packed = codec.packed(text)
                ids = array("I")
                ids.frombytes(packed)
                decoded = codec.decode(ids).encode("utf-8")
                out.append((key_, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded).hexdigest()))
            cols = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_pydict({"row_ord": pa.array(cols[0], pa.int64()), "n_tokens": pa.array(cols[1], pa.int64()), "ids_sha256": pa.array(cols[2], pa.string()), "decoded_sha256": pa.array(cols[3], pa.string())})

    return records.select(F.col(key).cast("long").alias("row_ord"), F.col(body).alias("desc")).mapInArrow(run, DIGESTS)
