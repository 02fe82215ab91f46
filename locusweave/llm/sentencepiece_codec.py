"""SentencePiece encoding for merge-type vocabularies, and decoding.

Encoding keeps an agenda of adjacent symbol pairs whose concatenation is a piece, ordered by the piece's score and
then by place: the best pair is merged, its new neighbours enter the agenda, and stale entries are skipped. Symbols
that are no piece at the end become byte pieces. No piece has the space mark after another character (checked when a
vocabulary is loaded), so merges never cross the start of a run of marks and each such part is encoded alone and
remembered; the same holds for line feeds. Each Arrow batch is checked against the sentencepiece library, or the task
fails: every part that was not remembered is encoded by the library too, and so is one whole text, to check that the
ids of a text are those of its parts. Decoding is the library's decode(ids).

Defined cases: null counts as empty; an empty text has no ids and decodes to an empty text; decoding gives what the
library gives (a text's own space marks become spaces). Rows are independent, so repeated ids, extra columns and
empty tables need no care; a text is encoded whole, whatever its length.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusweave.llm.common import give_back_memory, kept_by_worker, runs_on_executors, small_batches

runs_on_executors(__name__)
MARK = "▁"
#: Bits for a symbol and for a place in a part.
SHIFT, PLACES = 22, 32
#: Parts of up to so many characters are merged many at a time.
SHORT = 24
NOTHING = np.iinfo(np.int64).max
#: Bytes that the parts which a worker remembers may take, and what one takes besides its characters and ids.
REMEMBERED = 48 << 20
PART_BYTES = 200
ROWS_AT_ONCE = 256


class Encoder:
    """A vocabulary of the merge type with byte fallback and the plain normaliser."""

    def __init__(self, model: bytes, remembered: int = REMEMBERED):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = self.library.get_piece_size()
        kinds = [self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i) for i in range(n)]
        self.size, self.pieces = n, {self.library.id_to_piece(i): i for i in range(n) if not kinds[i]}
        ranks = {s: k for k, s in enumerate(sorted({-self.library.get_score(i) for i in self.pieces.values()}))}
        self.characters = {p: i for p, i in self.pieces.items() if len(p) == 1}
        for c in sorted({c for p in self.pieces for c in p} - self.characters.keys()):
            self.characters[c] = n + len(self.characters)
        symbols = self.pieces | self.characters
        self.merges = {
            symbols[p[:k]] << SHIFT | symbols[p[k:]]: ranks[-self.library.get_score(i)] << SHIFT | i
            for p, i in self.pieces.items()
            for k in range(1, len(p))
            if p[:k] in symbols and p[k:] in symbols
        }
        self.bytes = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if any(MARK in p.lstrip(MARK) for p in self.pieces):
            raise ValueError("a piece has a space mark inside; texts of this vocabulary cannot be cut at marks")
        feeds = "" if any("\n" in p for p in self.pieces) else "\n"
        self.parts = re.compile(f"{MARK}+[^{MARK}{feeds}]*|[^{MARK}{feeds}]+" + ("|\n+" if feeds else ""))
        self.remembered, self.known, self.held = remembered, {}, 0
        # Ids are kept as packed numbers.
        self.code = "H" if n <= 1 << 16 else "I"
        self.packed = np.dtype(self.code)
        self.unchecked: list[str] = []
        order = sorted(self.merges)
        self.pair_keys = np.array(order, np.int64)
        self.pair_made = np.array([self.merges[k] for k in order], np.int64)
        self.by_code = np.full(0x110000, -1, np.int64)
        for c, i in self.characters.items():
            self.by_code[ord(c)] = i
        scores = Counter(self.library.get_score(i) for p, i in self.pieces.items() if len(p) > 1)
        self.tied = [p for p, i in self.pieces.items() if len(p) > 1 and scores[self.library.get_score(i)] > 1]
        self.tied = [t for t in self.tied if not any(o != t and o in t for o in self.tied)]
        if len(self.tied) > 20:
            self.tied = [""]

    def part(self, text: str) -> tuple[int, ...]:
        """Merge one part with the agenda.

        Symbols are numbers: a piece's id, a number behind the ids for a character that only larger pieces have, -1 for
        any other character, -2 for a symbol merged into its left neighbour. An agenda entry is (rank, place).
        """
        merges, n = self.merges, len(text)
        symbols = [self.characters.get(c, -1) for c in text]
        symbols.append(-1)
        left, right = list(range(-1, n)), list(range(1, n + 1))
        agenda = []
        for i in range(n - 1):
            if (made := merges.get(symbols[i] << SHIFT | symbols[i + 1])) is not None:
                agenda.append((made >> SHIFT) << PLACES | i)
        heapify(agenda)
        while agenda:
            entry = heappop(agenda)
            i = entry & (1 << PLACES) - 1
            j = right[i]
            made = merges.get(symbols[i] << SHIFT | symbols[j])
            if made is None or made >> SHIFT != entry >> PLACES:
                continue  # one of the two was merged with another meanwhile
            symbols[i], symbols[j] = made & (1 << SHIFT) - 1, -2
            k = right[i] = right[j]
            left[k] = i
            if (made := merges.get(symbols[i] << SHIFT | symbols[k])) is not None:
                heappush(agenda, (made >> SHIFT) << PLACES | i)
            k = left[i]
            if k >= 0 and (made := merges.get(symbols[k] << SHIFT | symbols[i])) is not None:
                heappush(agenda, (made >> SHIFT) << PLACES | k)
        symbols.pop()
        if -1 not in symbols and max(symbols) < self.size:
            return tuple([s for s in symbols if s >= 0])
        out: list[int] = []
        for c, s in zip(text, symbols):
            if 0 <= s < self.size:
                out.append(s)
            elif s != -2:
                out += [self.bytes[b] for b in c.encode()]
        return tuple(out)

    def pack(self, ids) -> bytes:
        return array(self.code, ids).tobytes()

    def short_parts(self, parts: list[str]) -> list[bytes | None]:
        """Merge many short parts together; packed ids, or None for a part that needs bytes or has pieces of equal score.

        Each part is a row of symbols beside its agenda, the row of (rank, piece) of its adjacent pairs. Each round takes
        the least entry of every row, the first of equal ones, merges it and renews the entries of its neighbours.
        """
        chars = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32)
        lengths = np.array([len(p) for p in parts])
        found = self.by_code[chars]
        width = int(lengths.max())
        symbols = np.full((len(parts), width + 1), -1, np.int64)
        symbols[:, :width][np.arange(width) < lengths[:, None]] = found
        plain = (symbols < self.size).all(1) & ((symbols[:, :width] >= 0).sum(1) == lengths)
        agenda = self._made(symbols[:, :-1] << SHIFT | symbols[:, 1:])
        out: list[bytes | None] = [None] * len(parts)
        rows, cols = np.flatnonzero(plain), np.arange(width + 1)
        symbols, agenda = symbols[rows], agenda[rows]
        while len(rows):
            at = agenda.argmin(1)
            here = np.arange(len(rows))
            best = agenda[here, at]
            done = best == NOTHING
            if done.any():
                ready = symbols[done]
                ends = (ready >= 0).sum(1) * self.packed.itemsize
                flat, wide = ready.astype(self.packed).tobytes(), ready.shape[1] * self.packed.itemsize
                for k, (r, end) in enumerate(zip(rows[done].tolist(), ends.tolist())):
                    out[r] = flat[k * wide : k * wide + end]
                rows, symbols, agenda, at, best = (x[~done] for x in (rows, symbols, agenda, at, best))
                here = here[: len(rows)]
            if not len(rows):
                break
            moved = np.concatenate([symbols[:, 1:], np.full((len(rows), 1), -1)], 1)
            symbols = np.where(cols <= at[:, None], symbols, moved)
            symbols[here, at] = best & (1 << SHIFT) - 1
            moved = np.concatenate([agenda[:, 1:], np.full((len(rows), 1), NOTHING)], 1)
            agenda = np.where(cols[:-1] < at[:, None], agenda, moved)
            agenda[here, at] = self._made(symbols[here, at] << SHIFT | symbols[here, at + 1])
            inner = np.flatnonzero(at > 0)
            agenda[inner, at[inner] - 1] = self._made(symbols[inner, at[inner] - 1] << SHIFT | symbols[inner, at[inner]])
        return out

    def _made(self, pairs: np.ndarray) -> np.ndarray:
        """(rank, piece) that each pair makes, NOTHING if none."""
        at = np.searchsorted(self.pair_keys, pairs).clip(0, len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == pairs, self.pair_made[at], NOTHING)

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        cut = [self.parts.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        known = self.known
        new = [p for p in dict.fromkeys(chain.from_iterable(cut)) if p not in known]
        by_length = sorted((p for p in new if len(p) <= SHORT and not any(t in p for t in self.tied)), key=len)
        for a in range(0, len(by_length), 4096):
            known.update((p, ids) for p, ids in zip(by_length[a : a + 4096], self.short_parts(by_length[a : a + 4096])) if ids is not None)
        known.update((p, self.pack(self.part(p))) for p in new if p not in known)
        self.held += sum(PART_BYTES + 2 * len(p) + len(known[p]) for p in new)
        self.unchecked += new
        return [np.frombuffer(b"".join(map(known.__getitem__, parts)), self.packed) for parts in cut]

    def forget(self, most: int | None = None) -> None:
        """Start afresh when the remembered parts take too many bytes."""
        if self.held > (self.remembered if most is None else most):
            self.known, self.held = {}, 0

    def encode(self, text: str) -> list[int]:
        return self.encode_batch([text])[0].tolist()

    def check(self, text: str) -> None:
        """Compare the parts encoded since the last check, and a whole text, with the library.

        The library puts a space mark before a text: a part that starts with one goes without it, another part goes
        behind a line feed, which merges with nothing.
        """
        same = self.library.encode(text) == self.encode(text)
        parts = self.unchecked
        marked = [p[0] == MARK for p in parts]
        theirs = self.library.encode([p[1:] if m else "\n" + p for p, m in zip(parts, marked)], num_threads=1) if parts else []
        feed = self.library.encode("\n")
        for part, m, ids in zip(parts, marked, theirs):
            if m and not part[1:]:
                ids = self.library.encode("\n" + part)[len(feed) :]
            same = same and self.known[part] == self.pack(ids if m else ids[len(feed) :])
            if not same:
                raise ValueError(f"ids differ from the library's for {part[:60]!r}")
        if not same:
            raise ValueError(f"ids differ from the library's for the text that starts with {text[:60]!r}")
        self.unchecked = []


def model_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode_decode(docs: DataFrame, model: bytes) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_tokens, ids, decoded; a row per document. model: the vocabulary file."""
    return _run(docs, model, False)


def digests(docs: DataFrame, model: bytes) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_tokens, ids_sha256, decoded_sha256; a row per document."""
    return _run(docs, model, True)


def _run(docs: DataFrame, model: bytes, digest: bool) -> DataFrame:
    shared, key = docs.sparkSession.sparkContext.broadcast(model), hashlib.sha256(model).hexdigest()
    id_type = docs.schema["doc_id"].dataType.simpleString()
    kind = "ids_sha256 string, decoded_sha256 string" if digest else "ids array<int>, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = kept_by_worker("sentencepiece", key, lambda: Encoder(shared.value))
        names = [str(i) for i in range(own.library.get_piece_size())]
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for whole in batches:
            for a in range(0, len(whole), ROWS_AT_ONCE):
                batch = whole.slice(a, ROWS_AT_ONCE)
                counts, ids_out, texts_out = [], [], []
                texts = batch.column(1).to_pylist()
                for packed in own.encode_batch(texts):
                    ids = packed.tolist()
                    back = own.library.decode(ids) if ids else ""
                    counts.append(len(ids))
                    ids_out.append(sha(",".join([names[i] for i in ids])) if digest else ids)
                    texts_out.append(sha(back) if digest else back)
                own.check(texts[0])
                own.forget()
                ids_type = pa.string() if digest else pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_out, ids_type), pa.array(texts_out, pa.string())],
                    ["doc_id", "n_tokens", "ids_sha256" if digest else "ids", "decoded_sha256" if digest else "decoded"],
                )
        own.forget(0)  # an idle worker keeps the vocabulary, not the parts
        give_back_memory()

    return small_batches(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, f"doc_id {id_type}, n_tokens long, {kind}")
