"""SentencePiece encoding and decoding by a batched numpy Viterbi search.

The texts of a batch become one array of code points. It is cut wherever no
piece of the vocabulary spans two neighbouring code points; the distinct words
between the cuts are grouped by length, and all words of one length advance
together: at each position the hashes of the substrings that end there probe
the sorted keys of the pieces, and the best candidate and its backpointer are
stored for all words at once.

In a unigram model a piece's score is a log probability. Each position keeps the
maximum, over the pieces that end there, of the piece's score and the sum where it
begins; of equal sums the longer last piece wins. A code point that is no piece
scores 10 less than the lowest piece. Sums are of 64 bits and start at each word,
the library's are of 32 bits and start at the text, so where two segmentations have
the same sum, or differ in the seventh digit, rounding may pick the other one there.

In a BPE model the scores are merge ranks (whole numbers: this tells the two kinds
apart), and the segmentation with the highest sum isn't the one the merges lead to.
There a candidate is taken, longest first, if it and the piece stored where it begins
are neighbours in a BPE result, that is if merging the characters
of both, lowest rank first, leads back to just these two. Every prefix of a
word then has exactly one path, its own BPE result, so nothing is left to
maximise, and the ids are those of the library. Whether two pieces may be neighbours is read off the order in which
merges build the last symbols of the one and the first of the other; answers
are kept for the task.

Defined cases: a null or empty text has no ids and decodes to the empty text.
Code points outside the vocabulary become their UTF-8 bytes; a vocabulary without
pieces for bytes is refused. Decoding gives
the text back exactly, except that U+2581, which stands for the space in the
pieces, comes back as a space.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = 0x2581
CODES_AT_ONCE = 2_500_000
#: For a stage beside others: less memory, but words are shared among fewer texts.
CODES_IN_A_STAGE = 600_000
ROWS_AT_ONCE = 750
_LEADING_BITS = 20
_REMEMBERED_BITS = 20
_DENSE = 1024
_BASE = 0x9E3779B97F4A7C15 | 1
_NEVER = np.int64(2**62)
UNKNOWN = -1
#: Fixed value: how far below the lowest piece of a unigram model an unknown code point scores.
UNKNOWN_PENALTY = 10.0


def _mix(x: np.ndarray, length) -> np.ndarray:
    x = x + np.uint64(0xD1B54A32D192ED03) * np.asarray(length, np.uint64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class Pieces:
    """The vocabulary as sorted substring keys, and what is derived from it once."""

    def __init__(self, pieces: list[str], scores: list[float], normal: list[bool], byte_ids: list[int],
                 unigram: bool = False):
        self.pieces, self.byte_ids = pieces, np.array(byte_ids, np.int32)
        size = len(pieces)
        self.length = np.zeros(size, np.int64)
        self.raw = np.zeros(size, np.uint64)
        bigrams = set()
        for i, piece in enumerate(pieces):
            if normal[i]:
                h = 0
                for c in piece:
                    h = (h * _BASE + ord(c) + 1) % 2**64
                self.raw[i], self.length[i] = h, len(piece)
                bigrams.update(zip(map(ord, piece), map(ord, piece[1:])))
        # the order in which merges happen: the higher score first; single code points are there from the start
        order = sorted((i for i in range(size) if normal[i] and self.length[i] > 1), key=lambda i: (-scores[i], i))
        self.rank = np.full(size + 1, -1, np.int64)
        self.rank[order] = np.arange(len(order))
        self.longest = int(self.length.max(initial=1))
        self.power = np.array([pow(_BASE, i, 2**64) for i in range(self.longest + 1)], np.uint64)
        self.scores = None
        if unigram:  # the last place is that of UNKNOWN
            lowest = min((x for x, n in zip(scores, normal) if n), default=0.0)
            self.scores = np.array([*scores, lowest - UNKNOWN_PENALTY])
        known = np.flatnonzero(normal)
        self._index(known)
        self.joins = np.zeros((_DENSE, _DENSE), bool)
        far = []
        for a, b in bigrams:
            if a < _DENSE and b < _DENSE:
                self.joins[a, b] = True
            else:
                far.append(a << 21 | b)
        self.far = np.array(sorted(far), np.int64)
        self.left = np.full(size + 1, -1, np.int64)
        self.right = np.full(size + 1, -1, np.int64)
        if not unigram:
            self._split(pieces, order)

    def _index(self, ids: np.ndarray) -> None:
        keys = _mix(self.raw[ids], self.length[ids])
        by = np.argsort(keys)
        self.keys, self.ids = keys[by], ids[by].astype(np.int32)
        # which values the leading bits of a key take: most substrings are no piece and end here
        self.leading = np.zeros(1 << _LEADING_BITS, bool)
        self.leading[self.keys >> np.uint64(64 - _LEADING_BITS)] = True

    def find(self, raw: np.ndarray, length) -> np.ndarray:
        """Piece ids of substring hashes, UNKNOWN where there is none."""
        keys = _mix(raw, length)
        out = np.full(len(keys), UNKNOWN, np.int32)
        some = np.flatnonzero(self.leading[keys >> np.uint64(64 - _LEADING_BITS)])
        if len(some):
            keys = keys[some]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            out[some] = np.where(self.keys[at] == keys, self.ids[at], UNKNOWN)
        return out

    def _split(self, pieces: list[str], order: list[int]) -> None:
        """The last merge that builds each piece; pieces that merges never build leave the index."""
        ranks = {pieces[i]: int(self.rank[i]) for i in order}
        name = {p: i for i, p in enumerate(pieces) if self.length[i]}
        unreachable = []
        for i in order:
            symbols = list(pieces[i])
            while len(symbols) > 2:
                found = [(ranks.get(a + b, _NEVER), j) for j, (a, b) in enumerate(zip(symbols, symbols[1:]))]
                best, j = min(found)
                if best == _NEVER or best >= self.rank[i]:
                    break
                symbols[j: j + 2] = [symbols[j] + symbols[j + 1]]
            if len(symbols) == 2:
                self.left[i], self.right[i] = (name.get(s, UNKNOWN) for s in symbols)
            else:
                unreachable.append(i)
        if unreachable:
            self._index(np.setdiff1d(self.ids, unreachable))

    def neighbours(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether a BPE result may hold piece a right before piece b.

        Walks back in time from both whole pieces: the symbols that meet at the
        border are a's last and b's first; they would have merged if their join
        has a rank before either of them grew. Ties go to the left.
        """
        n = len(a)
        ok = np.ones(n, bool)
        x, y = a.astype(np.int64), b.astype(np.int64)
        grows_x, grows_y = np.full(n, _NEVER), np.full(n, _NEVER)
        live = np.flatnonzero((x >= 0) & (y >= 0))
        while len(live):
            xs, ys = x[live], y[live]
            width = self.length[xs] + self.length[ys]
            joined = np.where(width <= self.longest, self.find(
                self.raw[xs] * self.power[self.length[ys]] + self.raw[ys], width), UNKNOWN)
            rank = np.where(joined >= 0, self.rank[joined], _NEVER)
            ok[live[(rank < grows_x[live]) & (rank <= grows_y[live])]] = False
            later_x = self.rank[xs] > self.rank[ys]
            tied = (self.rank[xs] == self.rank[ys]) & (self.rank[xs] >= 0)
            later_x &= ~tied  # of two equal merges the left comes first, so the right one is undone first
            step = live[later_x]
            grows_x[step] = self.rank[x[step]]
            x[step] = self.right[x[step]]
            step = live[~later_x]
            ended = self.left[y[step]] < 0  # both are single code points
            grows_y[step] = self.rank[y[step]]
            y[step] = self.left[y[step]]
            live = np.r_[live[later_x], step[~ended]]
            live = live[ok[live] & (x[live] >= 0) & (y[live] >= 0)]
        return ok


def load(model: str = MODEL) -> Pieces:
    """Read the vocabulary file (on the driver; the tables are shipped with the tasks)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    n = sp.get_piece_size()
    special = [sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)]
    scores = [sp.get_score(i) for i in range(n)]
    byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    if not all(map(sp.is_byte, byte_ids)):
        raise ValueError(f"{model} has no pieces for bytes")
    unigram = any(not x.is_integer() for x, s in zip(scores, special) if not s)
    return Pieces([sp.id_to_piece(i) for i in range(n)], scores, [not s for s in special], byte_ids, unigram)


class Encoder:
    """Encodes batches of texts; remembers which pieces may be neighbours."""

    def __init__(self, pieces: Pieces):
        self.v = pieces
        # one place for each remembered pair, the last that came there: bounded, and exact by its key
        self._pairs = np.full(1 << _REMEMBERED_BITS, -1, np.int64)
        self._answers = np.zeros(1 << _REMEMBERED_BITS, bool)

    def _neighbours(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) << 32 | b
        place = (key.view(np.uint64) * np.uint64(_BASE)) >> np.uint64(64 - _REMEMBERED_BITS)
        answers = self._answers[place]
        new = np.flatnonzero(self._pairs[place] != key)
        if len(new):
            distinct, inverse = np.unique(key[new], return_inverse=True)
            found = self.v.neighbours(distinct >> 32, distinct & 0xFFFFFFFF)
            answers[new] = found[inverse]
            self._pairs[place[new]], self._answers[place[new]] = key[new], answers[new]
        return answers

    def _words(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of all words of one length (rows of ``codes``): (back, last).

        ``back[w, i]`` is the length of the last piece of the prefix of length
        i, and ``last[w, i]`` its id (UNKNOWN: a code point to be spelled in bytes).
        """
        n, length = codes.shape
        v = self.v
        prefix = np.zeros((n, length + 1), np.uint64)
        for i in range(length):
            prefix[:, i + 1] = prefix[:, i] * np.uint64(_BASE) + codes[:, i] + np.uint64(1)
        back = np.zeros((n, length + 1), np.int16)
        last = np.full((n, length + 1), UNKNOWN, np.int32)
        (self._merged if v.scores is None else self._best)(prefix, back, last)
        return back, last

    def _best(self, prefix: np.ndarray, back: np.ndarray, last: np.ndarray) -> None:
        """Fills ``back`` and ``last`` with the paths of the highest sums of scores."""
        v = self.v
        total = np.zeros(prefix.shape)
        for i in range(1, prefix.shape[1]):
            top = np.full(len(prefix), -np.inf)
            for size in range(min(v.longest, i), 0, -1):
                found = v.find(prefix[:, i] - prefix[:, i - size] * v.power[size], size)
                sums = total[:, i - size] + v.scores[found]
                better = sums > top
                if size > 1:
                    better &= found >= 0
                top[better], back[better, i], last[better, i] = sums[better], size, found[better]
            total[:, i] = top

    def _merged(self, prefix: np.ndarray, back: np.ndarray, last: np.ndarray) -> None:
        """Fills ``back`` and ``last`` with the one path that merges lead to."""
        v, n = self.v, len(prefix)
        for i in range(1, prefix.shape[1]):
            best = np.zeros(n, np.int16)
            for size in range(min(v.longest, i), 0, -1):
                open_ = np.flatnonzero(best == 0)
                if not len(open_):
                    break
                found = v.find(prefix[open_, i] - prefix[open_, i - size] * v.power[size], size)
                if size > 1:
                    open_, found = open_[found >= 0], found[found >= 0]
                good = np.ones(len(open_), bool)
                if i > size and len(open_):
                    before = last[open_, i - size]
                    both = np.flatnonzero((before >= 0) & (found >= 0))
                    good[both] = self._neighbours(before[both], found[both])
                best[open_[good]] = size
                last[open_[good], i] = found[good]
            back[:, i] = np.where(best == 0, 1, best)

    def _tokens(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after the other, ids per word) for words of one length."""
        n, length = codes.shape
        back, last = self._words(codes)
        out = np.full((n, length), -2, np.int32)  # read from the end to the start
        at, row = np.full(n, length), np.arange(n)
        for step in range(length):
            live = at > 0
            if not live.any():
                break
            token = last[row, at]
            spelled = live & (token == UNKNOWN)
            out[live, step] = token[live]
            out[spelled, step] = -3 - codes[spelled, at[spelled] - 1].astype(np.int32)
            at = at - np.where(live, back[row, at], 0)
        out = out[:, ::-1]
        used = out != -2
        return out[used], used.sum(1)

    def _flat(self, codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per part) of an array of code points; ``starts`` holds where its parts begin."""
        v = self.v
        a, b = codes[:-1].astype(np.int64), codes[1:].astype(np.int64)
        near = (a < _DENSE) & (b < _DENSE)
        joins = np.zeros(len(a), bool)
        joins[near] = v.joins[a[near], b[near]]
        far = np.flatnonzero(~near)
        if len(far) and len(v.far):
            key = a[far] << 21 | b[far]
            at = np.minimum(np.searchsorted(v.far, key), len(v.far) - 1)
            joins[far] = v.far[at] == key
        cut = np.r_[True, ~joins]
        cut[starts[starts < len(codes)]] = True
        begin = np.flatnonzero(cut)
        size = np.diff(np.r_[begin, len(codes)])
        wide = codes.astype(np.uint64)
        h = np.zeros(len(begin), np.uint64)
        live, step = np.arange(len(begin)), 0
        while len(live):
            h[live] = h[live] * np.uint64(_BASE) + wide[begin[live] + step] + np.uint64(1)
            step += 1
            live = live[size[live] > step]
        _, first, inverse = np.unique(_mix(h, size), return_index=True, return_inverse=True)
        counts = np.zeros(len(first), np.int64)
        pools, offset = [], np.zeros(len(first), np.int64)
        held = 0
        for length in np.unique(size[first]):
            group = np.flatnonzero(size[first] == length)
            for i in range(0, len(group), 200_000):
                part = group[i: i + 200_000]
                ids, per = self._tokens(codes[begin[first[part]][:, None] + np.arange(length)])
                counts[part] = per
                offset[part] = held + np.cumsum(per) - per
                held += len(ids)
                pools.append(ids)
        pool = np.concatenate(pools) if pools else np.zeros(0, np.int32)
        per_word = counts[inverse]
        ends = np.cumsum(per_word)
        index = np.repeat(offset[inverse] - (ends - per_word), per_word) + np.arange(ends[-1] if len(ends) else 0)
        ids = pool[index]
        owner = np.searchsorted(starts, begin, side="right") - 1
        owner = np.repeat(owner, per_word)
        spelled = np.flatnonzero(ids <= -3)
        if len(spelled):
            raw = [chr(c).encode("utf-8", "surrogatepass") for c in (-3 - ids[spelled])]
            repeat = np.ones(len(ids), np.int64)
            repeat[spelled] = [len(r) for r in raw]
            place = np.repeat(ids <= -3, repeat)
            ids, owner = np.repeat(ids, repeat), np.repeat(owner, repeat)
            ids[place] = self.v.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        return ids, np.bincount(owner, minlength=len(starts))

    def encode(self, texts: list[str | None], codes_at_once: int | None = None) -> list[np.ndarray]:
        """The ids of each text."""
        most = codes_at_once or CODES_AT_ONCE
        parts, owner = [], []
        for i, text in enumerate(texts):
            if text:
                codes = np.frombuffer((" " + text).encode("utf-32-le", "surrogatepass"), np.uint32).copy()
                codes[codes == 32] = SPACE
                at = 0
                while at < len(codes):  # a very long text goes on in parts, cut before a space after another code point
                    end = min(len(codes), at + most)
                    if end < len(codes):
                        edges = np.flatnonzero((codes[at + 1: end] == SPACE) & (codes[at: end - 1] != SPACE))
                        while not len(edges) and end < len(codes):
                            end = min(len(codes), 2 * end - at)
                            edges = np.flatnonzero((codes[at + 1: end] == SPACE) & (codes[at: end - 1] != SPACE))
                        if end < len(codes) and len(edges):
                            end = at + 1 + int(edges[-1])
                    parts.append(codes[at:end]), owner.append(i)
                    at = end
        found: list[list[np.ndarray]] = [[] for _ in texts]
        i = 0
        while i < len(parts):
            j, held = i, 0
            while j < len(parts) and (j == i or held + len(parts[j]) <= most):
                held += len(parts[j])
                j += 1
            starts = np.cumsum([0, *map(len, parts[i: j - 1])])
            ids, per = self._flat(np.concatenate(parts[i:j]), starts)
            for k, piece in enumerate(np.split(ids, np.cumsum(per)[:-1])):
                found[owner[i + k]].append(piece)
            i = j
        return [np.concatenate(f).astype(np.int32) if f else np.zeros(0, np.int32) for f in found]


def decode(ids: np.ndarray, pieces: list[str], byte_of: dict[int, int]) -> str:
    """The text of ``ids``: bytes are gathered into code points, and the space put in front is taken off."""
    out, raw = [], bytearray()
    for i in ids.tolist():
        b = byte_of.get(i)
        if b is None:
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw = bytearray()
            out.append(pieces[i])
        else:
            raw.append(b)
    if raw:
        out.append(raw.decode("utf-8", "replace"))
    text = "".join(out).replace(chr(SPACE), " ")
    return text[1:] if text.startswith(" ") else text


def encode_texts(docs: DataFrame, model: str = MODEL, text_col: str = "text", out: str = "ids",
                 codes_at_once: int = CODES_IN_A_STAGE) -> DataFrame:
    """``docs`` with one more column ``out`` (array of int) with the ids of its text."""
    pieces = load(model)
    named = {c: f"_in_{i}" for i, c in enumerate(docs.columns)}
    inner = docs.select([F.col(f"`{c}`").alias(n) for c, n in named.items()])
    at = docs.columns.index(text_col)

    def run(batches):
        encoder = Encoder(pieces)
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(i, ROWS_AT_ONCE)
                ids = encoder.encode([t.as_py() for t in part.column(at)], codes_at_once)
                yield part.append_column("_ids", pa.array(ids, pa.list_(pa.int32())))

    kinds = ", ".join(f"{named[f.name]} {f.dataType.simpleString()}" for f in docs.schema)
    done = inner.mapInArrow(run, f"{kinds}, _ids array<int>")
    return done.select(*[F.col(n).alias(c) for c, n in named.items()], F.col("_ids").alias(out))


def decode_ids(rows: DataFrame, model: str = MODEL, ids_col: str = "ids", keep: tuple[str, ...] = ("doc_id",),
               out: str = "text") -> DataFrame:
    """The columns ``keep`` of ``rows`` and the text of its ids."""
    pieces = load(model)
    kept = rows.select(*keep, ids_col)

    def run(batches):
        byte_of = {int(t): b for b, t in enumerate(pieces.byte_ids)}
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                texts = [decode(ids.values.to_numpy(zero_copy_only=False), pieces.pieces, byte_of)
                         if ids.is_valid else "" for ids in part.column(len(keep))]
                yield part.select(list(range(len(keep)))).append_column("_text", pa.array(texts, pa.string()))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
    return kept.mapInArrow(run, f"{kinds}, _text string").withColumnRenamed("_text", out)


def digests(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): ids as little-endian 32-bit numbers, text as UTF-8.

    One pass encodes and decodes, so neither the ids nor the texts are shuffled or stored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    pieces = load(model)

    def run(batches):
        encoder = Encoder(pieces)
        byte_of = {int(t): b for b, t in enumerate(pieces.byte_ids)}
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(i, ROWS_AT_ONCE)
                ids = encoder.encode([t.as_py() for t in part.column(1)])
                texts = [decode(x, pieces.pieces, byte_of) for x in ids]
                yield pa.record_batch([
                    part.column(0), pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x.astype("<i4").tobytes()).hexdigest() for x in ids]),
                    pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in texts])],
                    names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
