"""Byte-level BPE: vectorised pre-tokenisation, cached pair merging, offsets for decoding.

The split pattern (contractions, then runs of letters, numbers or other signs
with at most one leading space, then white space) is a finite automaton over
codepoint classes.  Each character is a function from states to states; the
functions compose associatively, so blocks of a text are reduced on their own,
their results scanned, and the states inside filled in, all on arrays.  No
regular expression runs.  The slices between boundaries are merged by rank once
and then come from a bounded cache.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custval.llm.arrays import binary_buffers, blocks

# ---- fixed values: classes of codepoints ------------------------------------------------
#: \s
WHITE_SPACE = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, 0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006,
               0x2007, 0x2008, 0x2009, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
KNOWN_VERSION = "15.1.0"
#: letters and numbers that Unicode 16 adds to version 15.1
NEW_LETTERS = ((0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
               (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
               (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C),
               (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0))
NEW_NUMBERS = ((0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9),
               (0x1E5F1, 0x1E5FA))
#: what may follow an apostrophe in a contraction
SHORT_ENDS, LONG_ENDS = "stmd", ("re", "ve", "ll")

# symbols: letter, number, other, apostrophe of a contraction of two or of three characters,
# a space before a non-space, other white space, white space (no space) before a non-space
LETTER, NUMBER, OTHER, QUOTE2, QUOTE3, SPACE, WHITE, LAST_WHITE = range(8)
# states, by what was read last: token ended, letters, numbers, others, a space that joins what follows, white space,
# inside a contraction with one or two characters to come
ENDED, IN_LETTERS, IN_NUMBERS, IN_OTHERS, JOINS, IN_WHITE, ONE_LEFT, TWO_LEFT = range(8)


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """(next state, does a token begin here) by symbol (+ 8 on a text's first character) and state."""
    step, begins = np.zeros((16, 8), np.uint8), np.ones((16, 8), bool)
    run = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, QUOTE2: ONE_LEFT, QUOTE3: TWO_LEFT,
           SPACE: JOINS, WHITE: IN_WHITE, LAST_WHITE: IN_WHITE}
    for symbol, state in run.items():
        step[symbol] = step[symbol + 8] = state
    for symbol in (LETTER, NUMBER, OTHER):
        begins[symbol, [run[symbol], JOINS]] = False
    for symbol in (QUOTE2, QUOTE3):                   # within a run of other signs an apostrophe is one of them
        step[symbol, [IN_OTHERS, JOINS]] = IN_OTHERS
        begins[symbol, [IN_OTHERS, JOINS]] = False
    begins[WHITE, IN_WHITE] = False
    step[LETTER, [TWO_LEFT, ONE_LEFT]] = ONE_LEFT, ENDED
    begins[LETTER, [TWO_LEFT, ONE_LEFT]] = False
    return step, begins


STEP, BEGINS = _automaton()
_CLASSES: list[np.ndarray] = []


def classes() -> np.ndarray:
    """LETTER, NUMBER, OTHER or WHITE of every codepoint (made once per process).

    The lists above add to version 15.1 of Unicode; an interpreter with another
    version would split other tokens, so it is refused.
    """
    if not _CLASSES:
        if unicodedata.unidata_version != KNOWN_VERSION:
            raise RuntimeError(f"Unicode {unicodedata.unidata_version}; the classes are complete for {KNOWN_VERSION}")
        kind = {"L": LETTER, "N": NUMBER}
        table = np.fromiter((kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
        for ranges, symbol in ((NEW_LETTERS, LETTER), (NEW_NUMBERS, NUMBER)):
            for a, b in ranges:
                table[a: b + 1] = symbol
        table[list(WHITE_SPACE)] = WHITE
        _CLASSES.append(table)
    return _CLASSES[0]


def symbols(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The automaton's input for codepoints of texts laid end to end; ``first`` marks where each begins."""
    n = len(codes)
    kind = classes()[codes]
    same_text = np.append(~first[1:], False)          # the next character belongs to the text
    solid_next = np.zeros(n, bool)
    solid_next[:-1] = kind[1:] != WHITE
    solid_next &= same_text
    out = kind.copy()
    white = (kind == WHITE) & solid_next
    out[white] = LAST_WHITE
    out[white & (codes == 0x20)] = SPACE
    quote = np.flatnonzero((codes == 0x27) & same_text)
    one = codes[quote + 1]
    out[quote[np.isin(one, [ord(c) for c in SHORT_ENDS])]] = QUOTE2
    quote, one = quote[same_text[quote + 1]], one[same_text[quote + 1]]
    two = codes[np.minimum(quote + 2, n - 1)]
    for a, b in LONG_ENDS:
        out[quote[(one == ord(a)) & (two == ord(b))]] = QUOTE3
    out[first] += 8
    return out


def token_starts(codes: np.ndarray, first: np.ndarray, width: int = 128) -> np.ndarray:
    """Where pre-tokens begin, by an associative scan of transition functions."""
    n = len(codes)
    if n == 0:
        return np.empty(0, np.int64)
    rows = -(-n // width)
    grid = np.full(rows * width, OTHER, np.intp)
    grid[:n] = symbols(codes, first)
    grid = np.ascontiguousarray((grid * 8).reshape(rows, width).T)       # one row per place in a block
    step, begins = STEP.ravel().astype(np.intp), BEGINS.ravel()
    function = np.tile(np.arange(8), (rows, 1))
    for symbol in grid:                               # each block's function, state by state
        function = step[symbol[:, None] + function]
    reach = 1
    while reach < rows:                               # prefix composition over the blocks
        later = np.take_along_axis(function[reach:], function[:-reach], 1)
        function = np.concatenate([function[:reach], later])
        reach *= 2
    state = np.concatenate([[ENDED], function[:-1, ENDED]])
    out = np.empty((width, rows), bool)
    for k, symbol in enumerate(grid):
        at = symbol + state
        out[k] = begins[at]
        state = step[at]
    return np.flatnonzero(out.T.ravel()[:n])


def decode_utf8(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(codepoints, bytes each takes); a byte that is not UTF-8 counts as a character of its own."""
    codes = np.frombuffer(raw.decode("utf-8", "surrogateescape").encode("utf-32-le", "surrogatepass"), "<u4")
    size = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
    size[(codes >= 0xDC80) & (codes <= 0xDCFF)] = 1
    return codes, size


class Merger(dict):
    """piece -> its ids as little-endian uint32 bytes; merged on demand, the cache is emptied at ``limit`` entries."""

    def __init__(self, ranks: dict[bytes, int], limit: int = 1 << 18, longest: int = 64):
        super().__init__()
        self.ranks, self.limit, self.longest = ranks, limit, longest

    def __missing__(self, piece: bytes) -> bytes:
        ids = np.array(self.merge(piece), "<u4").tobytes()
        if len(piece) <= self.longest:
            if len(self) >= self.limit:
                self.clear()
            self[piece] = ids
        return ids

    def merge(self, piece: bytes) -> list[int]:
        """Join the adjacent pair of lowest rank, leftmost first, until none has a rank."""
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        n = len(piece)
        end, prev = list(range(1, n + 1)), list(range(-1, n - 1))       # part i is piece[i:end[i]]
        alive = [True] * n
        heap = [(ranks[p], i, i + 2) for i in range(n - 1) if (p := piece[i: i + 2]) in ranks]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if not alive[i] or j >= n or end[j] != stop:
                continue                              # one of the two has grown or gone
            alive[j] = False
            end[i] = stop
            if stop < n:
                prev[stop] = i
                if (p := piece[i: end[stop]]) in ranks:
                    heapq.heappush(heap, (ranks[p], i, end[stop]))
            if (h := prev[i]) >= 0 and (p := piece[h:stop]) in ranks:
                heapq.heappush(heap, (ranks[p], h, stop))
        return [ranks[piece[i: end[i]]] for i in range(n) if alive[i]]


class Vocabulary:
    """Ranks of a vocabulary file (lines of base64 token and rank), its merger, and tables for decoding."""

    _loaded: dict[str, Vocabulary] = {}

    def __init__(self, raw: bytes):
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in raw.splitlines() if line)}
        self.merger = Merger(ranks)
        n = max(ranks.values()) + 1
        tokens = [b""] * n
        for token, rank in ranks.items():
            tokens[rank] = token
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    @classmethod
    def of(cls, raw: bytes) -> Vocabulary:
        """The vocabulary of a file's content, built once per process."""
        key = hashlib.sha256(raw).hexdigest()
        if key not in cls._loaded:
            cls._loaded[key] = cls(raw)
        return cls._loaded[key]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """Packed ids of texts laid end to end."""
        raw = data.tobytes()
        codes, size = decode_utf8(raw)
        at = np.concatenate([[0], np.cumsum(size)])
        begins = offsets[:-1][np.diff(offsets) > 0]
        if not np.isin(begins, at).all():             # the end of one text and the head of the next read as one character
            cuts = offsets.tolist()
            parts = [decode_utf8(raw[a:b]) for a, b in zip(cuts, cuts[1:])]
            codes, size = (np.concatenate(x) for x in zip(*parts))
            at = np.concatenate([[0], np.cumsum(size)])
        first = np.zeros(len(codes), bool)
        first[np.searchsorted(at, begins)] = True
        starts = at[token_starts(codes, first)]
        cuts = np.searchsorted(starts, offsets).tolist()
        bounds = starts.tolist() + [len(raw)]
        ids = list(map(self.merger.__getitem__, [raw[a:b] for a, b in zip(bounds, bounds[1:])]))
        return [b"".join(ids[a:b]) for a, b in zip(cuts, cuts[1:])]

    def places(self, ids: np.ndarray) -> np.ndarray:
        """Byte offset of each token in the text."""
        size = self.size[ids]
        return np.cumsum(size) - size

    def decode(self, ids: np.ndarray, places: np.ndarray | None = None) -> bytes:
        """The bytes of ``ids``, each token laid at its retained offset."""
        if len(ids) and int(ids.max()) >= len(self.size):
            raise ValueError(f"id {int(ids.max())} is not in the vocabulary")
        size = self.size[ids]
        places = self.places(ids) if places is None else places.astype(np.int64)
        out = np.zeros(int((places + size).max()) if len(ids) else 0, np.uint8)
        inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        out[np.repeat(places, size) + inner] = self.bytes[np.repeat(self.begin[ids], size) + inner]
        return out.tobytes()


def _file(df: DataFrame, path: str):
    """A vocabulary file (under one megabyte), read on the driver and sent to each executor once."""
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids and their byte offsets per row.

    Returns ``doc_id``, ``n_tokens``, ``ids`` and ``offsets`` (binary, packed
    little-endian uint32).  A null or empty text has no tokens; bytes that are
    not UTF-8 are encoded as single signs; repeated rows are encoded each;
    other columns are not read.
    """
    file = _file(docs, path)

    def run(batches):
        vocabulary = Vocabulary.of(file.value)
        for batch in batches:
            data, offsets = binary_buffers(batch["data"])
            for a, b, part, cut in blocks(data, offsets):
                ids = vocabulary.encode(part, cut)
                places = [vocabulary.places(np.frombuffer(x, "<u4")).astype("<u4").tobytes() for x in ids]
                yield pa.record_batch({"doc_id": batch["doc_id"].slice(a, b - a), "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                                       "ids": pa.array(ids, pa.binary()), "offsets": pa.array(places, pa.binary())})

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("data")).mapInArrow(
        run, "doc_id long, n_tokens long, ids binary, offsets binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with the ``decoded`` bytes; null ids give null, an id outside the vocabulary is an error."""
    file = _file(encoded, path)

    def run(batches):
        vocabulary = Vocabulary.of(file.value)
        for batch in batches:
            out = [None if i is None else vocabulary.decode(np.frombuffer(i, "<u4"), None if o is None else np.frombuffer(o, "<u4"))
                   for i, o in zip(batch["ids"].to_pylist(), batch["offsets"].to_pylist())]
            yield pa.RecordBatch.from_arrays([batch[c] for c in names] + [pa.array(out, pa.binary())], names + ["decoded"])

    names = ["doc_id", "n_tokens", "ids", "offsets"]
    return encoded.select(*names).mapInArrow(run, "doc_id long, n_tokens long, ids binary, offsets binary, decoded binary")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``encode`` and ``decode`` in one pass, with digests: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    file = _file(docs, path)

    def run(batches):
        vocabulary = Vocabulary.of(file.value)
        for batch in batches:
            data, offsets = binary_buffers(batch["data"])
            for a, b, part, cut in blocks(data, offsets):
                ids = vocabulary.encode(part, cut)
                decoded = [vocabulary.decode(i, vocabulary.places(i)) for i in (np.frombuffer(x, "<u4") for x in ids)]
                yield pa.record_batch({"doc_id": batch["doc_id"].slice(a, b - a), "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                                       "ids": pa.array(ids, pa.binary()), "decoded": pa.array(decoded, pa.binary())})

    out = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("data")).mapInArrow(
        run, "doc_id long, n_tokens long, ids binary, decoded binary")
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
