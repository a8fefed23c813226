"""Token counts by a deterministic transducer whose transitions carry numbers of emitted tokens.

The tokenizer is compiled to one machine over the bytes of split words, the last byte of a word being a letter of its
own. A state holds what later bytes can still change: for each place from which the bytes since then begin a token,
the token that ended there and how many tokens lay before it, against the present number. Reading a byte moves to the
next state and emits the change of the number of tokens of what is read so far, which may be 0 or less where a longer
token takes the place of shorter ones. After the last byte of a word the machine is back in its first state.

States are compiled when first reached, into a dense table that many chunks of text walk through in step. A chunk's
state map is the machine's action on it: the bytes up to the first word end (the head, whose effect depends on the
state in which the chunk is entered), then a count and an end state that do not. What follows the heads is walked for all
chunks at once; heads are then entered with the end state of the chunk before, in waves: this is a sequential hand-over where
a word spans many chunks, one wave for each.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.llm.wordsplit import WordFile, byte_letters, codes, normalised, piece_starts, segments

LAST = 256  # added to a word's last byte
CHUNK = 192
#: Beyond this many cells (4 bytes each) the compiled states are given up and compiled anew as text reaches them.
TABLE_CELLS = 20_000_000
BATCH_CHARS = 1 << 20


class Compiler:
    """Token boundaries of byte-pair merging, one byte at a time."""

    def __init__(self, file: WordFile):
        letters = byte_letters()
        self.first = [file.vocab[x] for x in letters] + [file.vocab[x + file.suffix] for x in letters]
        self.merges = {}
        for rank, (a, b) in enumerate(file.merges):
            self.merges.setdefault((file.vocab[a], file.vocab[b]), (rank, file.vocab[a + b]))
        of_letter = {x: i for i, x in enumerate(letters)}
        self.bytes_of = {}
        self.trie: dict[tuple[int, int], int] = {}
        self.token: dict[int, int] = {}
        self.inner: set[int] = set()
        for text, token in file.vocab.items():
            ends = text.endswith(file.suffix) and len(text) > len(file.suffix)
            body = text.removesuffix(file.suffix) if ends else text
            if not all(x in of_letter for x in body):
                continue
            symbols = [of_letter[x] for x in body]
            symbols[-1] += LAST * ends
            self.bytes_of[token] = symbols
            node = 0
            for s in symbols:
                self.inner.add(node)
                node = self.trie.setdefault((node, s), len(self.trie) + 1)
            self.token[node] = token
        self.fits: dict[tuple[int, int], bool] = {}
        self.seen: dict[tuple, tuple] = {}

    def merge(self, symbols: list[int]) -> list[int]:
        ids = [self.first[s] for s in symbols]
        while len(ids) > 1:
            best = min((self.merges.get(p, (1 << 40, 0)) + (i,) for i, p in enumerate(zip(ids, ids[1:]))), key=lambda x: (x[0], x[2]))
            if best[0] == 1 << 40:
                break
            ids[best[2] : best[2] + 2] = [best[1]]
        return ids

    def follows(self, before: int, token: int) -> bool:
        """Whether merging keeps ``token`` apart from ``before`` (-1: the word's start)."""
        key = (before, token)
        if key not in self.fits:
            own = self.bytes_of[token]
            if before < 0:
                self.fits[key] = self.merge(own) == [token]
            else:
                self.fits[key] = self.merge(self.bytes_of[before] + own) == [before, token]
        return self.fits[key]

    def step(self, state: tuple, symbol: int) -> tuple[tuple, int]:
        alive, emitted, token = [], None, -1
        for node, before, behind in state:
            after = self.trie.get((node, symbol))
            if after is None:
                continue
            alive.append((after, before, behind))
            found = self.token.get(after)
            if emitted is None and found is not None and self.follows(before, found):
                emitted, token = behind + 1, found
        if emitted is None:
            raise ValueError("the merges of this vocabulary do not build its tokens")
        if symbol >= LAST:
            return START, emitted
        kept = [(node, before, behind - emitted) for node, before, behind in alive if node in self.inner]
        # equal entries of different states are one object
        return tuple(self.seen.setdefault(e, e) for e in (*kept, (0, token, 0))), emitted


START = ((0, -1, 0),)


class Transducer:
    """The compiled part of the machine: ``next << 8 | emitted + 128`` for each state and letter, -1 where not compiled yet."""

    def __init__(self, path: str):
        self.file = WordFile(path)
        self.compiler = Compiler(self.file)
        self.columns = np.full(2 * LAST, -1, np.int32)
        self.letters: list[int] = []
        self.width = 64
        self.forget()

    def forget(self) -> None:
        self.compiler.seen.clear()
        self.states: list[tuple] = [START]
        self.number: dict[tuple, int] = {START: 0}
        self.table = np.full((1024, self.width), -1, np.int32)

    def _columns(self, symbols: np.ndarray) -> np.ndarray:
        new = np.unique(symbols[self.columns[symbols] < 0])
        for s in new.tolist():
            self.columns[s] = len(self.letters)
            self.letters.append(s)
        if len(self.letters) > self.width:
            wider = np.full((len(self.table), 2 * self.width), -1, np.int32)
            while len(self.letters) > wider.shape[1]:
                wider = np.full((len(self.table), 2 * wider.shape[1]), -1, np.int32)
            wider[:, : self.width] = self.table
            self.table, self.width = wider, wider.shape[1]
        return self.columns[symbols]

    def _compile(self, state: int, column: int) -> None:
        after, emitted = self.compiler.step(self.states[state], self.letters[column])
        n = self.number.get(after)
        if n is None:
            n = self.number[after] = len(self.states)
            self.states.append(after)
            if n >= len(self.table):
                self.table = np.concatenate([self.table, np.full((len(self.table) // 2, self.width), -1, np.int32)])
        self.table[state, column] = n << 8 | (emitted + 128)

    def walk(self, states: np.ndarray, columns: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """End states and emitted numbers of many stretches of ``columns`` walked in step."""
        order = np.argsort(-lengths, kind="stable")
        now, at, left = states[order].astype(np.int64), starts[order], lengths[order]
        total = np.zeros(len(order), np.int64)
        n = int(np.count_nonzero(left))
        done = 0
        while n:
            letter = columns[at[:n] + done]
            cell = self.table.ravel()[now[:n] * self.width + letter]
            if cell.min(initial=0) < 0:
                for s, c in set(zip(now[:n][cell < 0].tolist(), letter[cell < 0].tolist())):
                    self._compile(s, c)
                cell = self.table.ravel()[now[:n] * self.width + letter]
            now[:n] = cell >> 8
            total[:n] += (cell & 255) - 128
            done += 1
            n = int(np.searchsorted(-left, -done, side="left")) if left[n - 1] <= done else n
        ends, sums = np.empty_like(now), np.empty_like(total)
        ends[order], sums[order] = now, total
        return ends, sums

    def count(self, symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Tokens of each text; ``bounds`` are the texts' limits in ``symbols``, which end with a word each."""
        if self.table.size > TABLE_CELLS:
            self.forget()
        texts = len(bounds) - 1
        if not len(symbols):
            return np.zeros(texts, np.int64)
        columns = self._columns(symbols)
        # chunk limits: every CHUNK letters, and at every text's start
        cuts = np.union1d(np.arange(0, len(symbols), CHUNK), bounds[:-1][bounds[:-1] < bounds[1:]])
        lengths = np.diff(np.append(cuts, len(symbols)))
        ends_word = np.flatnonzero(symbols >= LAST)
        # the head of a chunk reaches to its first word end
        head_end = ends_word[np.searchsorted(ends_word, cuts)] + 1
        heads = np.minimum(head_end - cuts, lengths)
        synced = head_end <= cuts + lengths
        entered = np.zeros(len(cuts), bool)
        entered[np.searchsorted(cuts, bounds[:-1][bounds[:-1] < bounds[1:]])] = True
        entered[1:] |= symbols[cuts[1:] - 1] >= LAST
        tails, rest = self.walk(np.zeros(len(cuts), np.int64), columns, cuts + heads, np.where(synced, lengths - heads, 0))
        # hand-over: a head runs from the end state of the map before it; chunks without a word end wait for theirs
        into = np.zeros(len(cuts), np.int64)
        out = np.where(synced, tails, -1)
        head_sum = np.zeros(len(cuts), np.int64)
        todo = np.arange(len(cuts))
        while todo.size:
            known = entered[todo] | (out[todo - 1] >= 0)
            ready = todo[known]
            into[ready] = np.where(entered[ready], 0, out[ready - 1])
            reached, head_sum[ready] = self.walk(into[ready], columns, cuts[ready], heads[ready])
            open_ = ~synced[ready]
            out[ready[open_]] = reached[open_]
            todo = todo[~known]
        run = np.concatenate([[0], np.cumsum(rest + head_sum)])
        return run[np.searchsorted(cuts, bounds[1:])] - run[np.searchsorted(cuts, bounds[:-1])]


def letters_of(points: np.ndarray) -> np.ndarray:
    """Normalised code points to the machine's letters: the UTF-8 bytes of all pieces, the last of each piece marked."""
    inside, begins = piece_starts(points)
    at = np.flatnonzero(inside)
    if not at.size:
        return np.zeros(0, np.int32)
    used = points[at]
    last = np.empty(at.size, bool)
    last[-1] = True
    last[:-1] = begins[at[1:]]
    sizes = 1 + (used > 0x7F) + (used > 0x7FF) + (used > 0xFFFF)
    ends = np.cumsum(sizes)
    out = np.frombuffer(used.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8).astype(np.int32)
    out[ends[last] - 1] += LAST
    return out


_MACHINES: dict[str, Transducer] = {}


def machine(path: str) -> Transducer:
    if path not in _MACHINES:
        _MACHINES[path] = Transducer(path)
    return _MACHINES[path]


def count_batch(texts: Iterable[str], path: str) -> list[int]:
    """Token numbers of some texts, by one pass over all of their letters."""
    m = machine(path)
    parts: list[np.ndarray] = []
    ends, size = [0], 0
    counts: list[int] = []
    pending: list[int] = []
    extra: list[int] = []

    def flush():
        nonlocal parts, ends, size, pending
        if pending:
            letters = np.concatenate(parts) if parts else np.zeros(0, np.int32)
            for i, n in zip(pending, m.count(letters, np.array(ends)).tolist()):
                counts[i] += n
        parts, ends, size, pending = [], [0], 0, []

    for text in texts:
        counts.append(0)
        for k, part in enumerate(m.file.parts(text or "")):
            if k % 2:
                counts[-1] += 1
                continue
            for piece in segments(part):
                letters = letters_of(codes(normalised(piece)))
                parts.append(letters)
                size += len(letters)
                ends.append(size)
                pending.append(len(counts) - 1)
                if size > BATCH_CHARS:
                    flush()
    flush()
    return counts


def count_tokens(documents: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_bytes, n_tokens, over_limit`` of every whole text.

    Special strings inside a text are one token each. Null and empty texts have 0 bytes and tokens. Repeated rows are
    counted each; other columns are not read. A row is read and counted in one task; the work of a text is cut into
    chunks, so that its length only adds chunks.
    """
    narrow = documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
    kind = documents.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = count_batch((x.as_py() for x in batch.column(1)), path)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(counts, pa.int64())], ["_id", "n_bytes", "n_tokens"])

    counted = narrow.mapInArrow(run, f"_id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.select(F.col("_id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
