"""Token counts of a byte-level BPE tokenizer, compiled into deterministic transducers.

Two machines run over the texts of a slice at once:

* the *splitter* is a ten-state transducer over character classes whose
  transitions mark where the next piece begins (letters, digits, other signs,
  white space, contractions). Texts are laid end to end and cut into chunks;
  every chunk yields a map from each entry state to its exit state, the maps are
  composed by a parallel prefix scan, and then every chunk is run from its true
  entry state. No chunk waits for another, so a very long text is no special case.
* the *counter* reads the bytes of a piece. After each byte its state knows, for
  every earlier place from which a vocabulary entry could still go on, the last
  token before that place and how many tokens lie between; a transition carries
  the change in the number of tokens. Exactly one token can end each prefix,
  namely the one that forms a valid pair with the token before it, so the
  machine is deterministic. States and transitions are compiled when they are
  first met and then reused for all later pieces.

Defined results: a null or empty text has no bytes and no tokens; the
tokenizer's special strings inside a text are one token each, as the library
has it by default; every row is counted on its own, so repeated rows, null ids
and extra columns need no care; bytes that are no UTF-8 count as replacement
characters; a very long text is counted whole by one task; an empty table gives an
empty result.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import prefix_hashes, span_hashes, text_slices

CHUNK = 64
#: Compiled counter states, and remembered pieces, after which a worker starts afresh.
MOST_STATES, MOST_PIECES = 100_000, 2_000_000

# ---------------------------------------------------------------- the splitter

_CLASSES = ["letter", "stmd", "r", "v", "e", "l", "digit", "sign", "quote", "space", "white", "end"]
_STATES = ["new", "letters", "digits", "signs", "space", "white", "quote", "quote_r", "quote_v", "quote_l"]
_HERE, _BEFORE = 1, 2  # a piece begins with this character; with the one before it


def _splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next state and marks for each class (row) and state (column)."""
    step = np.zeros((len(_CLASSES), 16), np.uint8)
    mark = np.zeros_like(step)
    s = _STATES.index

    def go(c: str, state: str, to: str, marks: int) -> None:
        step[_CLASSES.index(c), s(state)], mark[_CLASSES.index(c), s(state)] = s(to), marks

    run_of = {c: "letters" for c in _CLASSES[:6]} | {"digit": "digits", "sign": "signs", "quote": "quote", "space": "space", "white": "white"}
    for c, run in run_of.items():
        letter, blank = run == "letters", c in ("space", "white")
        for state in ("new", "letters", "digits", "signs", "quote"):
            go(c, state, run, _HERE)
        if run in ("letters", "digits"):
            go(c, run, run, 0)
        go(c, "space", run if c != "quote" else "signs", 0 if blank else _BEFORE)
        go(c, "white", run, 0 if blank else _BEFORE | _HERE)
        if c in ("sign", "quote"):
            go(c, "signs", "signs", 0)
            go(c, "quote", "signs", 0)
        for state, last in (("quote_r", "e"), ("quote_v", "e"), ("quote_l", "l")):
            if c == last:
                go(c, state, "new", 0)
            else:  # no contraction: the quote stands alone and its letter begins a piece
                go(c, state, run, _BEFORE if letter else _BEFORE | _HERE)
    go("stmd", "quote", "new", 0)
    for c in ("r", "v", "l"):
        go(c, "quote", f"quote_{c}", 0)
    for state in _STATES:
        go("end", state, "new", _BEFORE if state.startswith("quote_") else 0)
    return step, mark


_STEP, _MARK = _splitter()


def character_classes() -> np.ndarray:
    """The splitter's class of every code point, as the tokenizer library's own regular expressions have it."""
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    # the planes beyond hold no letters, digits or white space
    points = np.concatenate((np.arange(0xD800), np.arange(0xE000, 0x40000))).astype(np.uint32)
    every = points.tobytes().decode("utf-32-le")
    out = np.full(0x110001, _CLASSES.index("sign"), np.uint8)
    for pattern, name in ((r"\p{L}", "letter"), (r"\p{N}", "digit"), (r"\s", "white")):
        for _, (a, b) in Split(Regex(f"[^{pattern}]"), "removed").pre_tokenize_str(every):
            out[points[a:b]] = _CLASSES.index(name)
    for text, name in (("stmd", "stmd"), ("r", "r"), ("v", "v"), ("e", "e"), ("l", "l"), ("'", "quote"), (" ", "space")):
        out[[ord(x) for x in text]] = _CLASSES.index(name)
    out[0x110000] = _CLASSES.index("end")
    return out


def split_marks(classes: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """Where pieces begin, for a sequence of classes that ends with an end."""
    n = len(classes)
    padded = np.full(-(-n // chunk) * chunk, _CLASSES.index("end"), np.uint8)
    padded[:n] = classes
    by_place = np.ascontiguousarray(padded.reshape(-1, chunk).T).astype(np.uint16) << 4
    step, mark = _STEP.reshape(-1), _MARK.reshape(-1)
    maps = np.tile(np.arange(len(_STATES), dtype=np.uint8), (by_place.shape[1], 1)).T.copy()
    for c in by_place:
        maps = step[c[None, :] | maps]
    # inclusive scan: maps[:, k] takes the state before the first chunk to the state after chunk k
    at = 1
    while at < maps.shape[1]:
        later, earlier = maps[:, at:], maps[:, :-at]
        maps = np.concatenate((maps[:, :at], np.take_along_axis(later, earlier.astype(np.intp), axis=0)), axis=1)
        at *= 2
    state = np.concatenate(([0], maps[0, :-1])).astype(np.uint8)
    marks = np.empty(by_place.shape, np.uint8)
    for k, c in enumerate(by_place):
        key = c | state
        marks[k] = mark[key]
        state = step[key]
    marks = marks.T.reshape(-1)[:n]
    begin = (marks & _HERE).astype(bool)
    begin[:-1] |= (marks[1:] & _BEFORE).astype(bool)
    return begin


# ---------------------------------------------------------------- the counter


def _byte_letters() -> dict[str, int]:
    """The printable letter by which a byte-level vocabulary writes each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Counter:
    """The lazily compiled transducer that counts the tokens of a piece."""

    def __init__(self, model: dict) -> None:
        letters = _byte_letters()
        self.text = {v: bytes(letters[c] for c in k) for k, v in model["vocab"].items() if all(c in letters for c in k)}
        ids = {t: i for i, t in self.text.items()}
        self.single = [ids[bytes([b])] for b in range(256)]
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        self.edges: tuple[dict, dict] = ({}, {})
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            a, b = (bytes(letters[c] for c in x) for x in (a, b))
            self.merge[ids[a], ids[b]] = (rank, ids[a + b])
            if ids[a + b] not in self.parts:
                self.parts[ids[a + b]] = (ids[a], ids[b])
                self.rank[ids[a + b]] = rank
        # the vocabulary as a trie; entries that the merges never reach are left out
        self.child: list[dict[int, int]] = [{}]
        self.token = [-1]
        for t, i in ids.items():
            if self.encode(t) != [i]:
                continue
            node = 0
            for b in t:
                if b not in self.child[node]:
                    self.child[node][b] = len(self.child)
                    self.child.append({})
                    self.token.append(-1)
                node = self.child[node][b]
            self.token[node] = i
        self.pair: dict[tuple[int, int], bool] = {}
        self.forget()

    def forget(self) -> None:
        self.states: list[tuple] = [((0, -1, 0),)]
        self.known = {self.states[0]: 0}
        self.next = np.full((1024, 256), -1, np.int32)
        self.more = np.zeros((1024, 256), np.int16)

    def encode(self, piece: bytes) -> list[int]:
        """Tokens of a piece by repeated merging of the pair of lowest rank."""
        parts = [self.single[b] for b in piece]
        while len(parts) > 1:
            rank, at = min((self.merge[p][0], i) if (p := (parts[i], parts[i + 1])) in self.merge else (1 << 30, i) for i in range(len(parts) - 1))
            if rank == 1 << 30:
                break
            parts[at : at + 2] = [self.merge[parts[at], parts[at + 1]][1]]
        return parts

    def edge(self, token: int, side: int) -> list[tuple[int, int, int]]:
        """Tokens at one edge of a token while merging builds it, each with the ranks between which it stands there."""
        found = self.edges[side].get(token)
        if found is None:
            chain = [token]
            while chain[-1] in self.parts:
                chain.append(self.parts[chain[-1]][side])
            rank = [self.rank.get(t, -1) for t in chain]
            found = self.edges[side][token] = [(t, rank[i], rank[i - 1] if i else 1 << 30) for i, t in enumerate(chain)]
        return found

    def valid(self, a: int, b: int) -> bool:
        """Whether two tokens side by side stay as they are.

        They don't if, while merging builds both, the token at the right edge of
        the first and that at the left edge of the second merge before either is
        used up; of equal ranks the pair further left goes first.
        """
        found = self.pair.get((a, b))
        if found is None:
            found = True
            for x, from_x, to_x in self.edge(a, 1):
                for y, from_y, to_y in self.edge(b, 0):
                    if from_x < to_y and from_y < to_x and (m := self.merge.get((x, y))) and m[0] < to_x and m[0] <= to_y:
                        found = False
            self.pair[a, b] = found
        return found

    def compile(self, state: int, byte: int) -> None:
        live, ends = [], None
        for node, before, back in self.states[state]:
            to = self.child[node].get(byte)
            if to is None:
                continue
            if ends is None and self.token[to] >= 0 and (before < 0 or self.valid(before, self.token[to])):
                ends = (self.token[to], back + 1)
            if self.child[to]:
                live.append((to, before, back))
        token, change = ends
        key = (*((node, before, back - change) for node, before, back in live), (0, token, 0))
        to = self.known.get(key)
        if to is None:
            to = self.known[key] = len(self.states)
            self.states.append(key)
            if to == len(self.next):
                self.next = np.concatenate((self.next, np.full_like(self.next, -1)))
                self.more = np.concatenate((self.more, np.zeros_like(self.more)))
        self.next[state, byte], self.more[state, byte] = to, change

    def run(self, buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Token counts of many pieces, a byte of each at a time."""
        if len(self.states) > MOST_STATES:
            self.forget()
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        state, count = np.zeros(len(starts), np.int32), np.zeros(len(starts), np.int64)
        active = np.searchsorted(-lengths, -np.arange(1, int(lengths[0]) + 1), "right") if len(lengths) else ()
        for j, m in enumerate(active):
            byte, now = buf[starts[:m] + j], state[:m]
            to = self.next[now, byte]
            missing = np.flatnonzero(to < 0)
            if len(missing):
                for key in np.unique((now[missing].astype(np.int64) << 8) | byte[missing]):
                    self.compile(int(key >> 8), int(key & 255))
                to = self.next[now, byte]
            count[:m] += self.more[now, byte]
            state[:m] = to
        out = np.empty_like(count)
        out[order] = count
        return out


class Tokenizer:
    """A byte-level BPE vocabulary file, compiled; pieces that were counted are remembered."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kind = spec.get("pre_tokenizer") or {}
        if spec["model"]["type"] != "BPE" or kind.get("type") != "ByteLevel" or kind.get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError("a byte-level BPE tokenizer without normalizer or added prefix space is needed")
        self.counter = Counter(spec["model"])
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.classes = character_classes()
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def count(self, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Token counts of each row of a slice."""
        rows = len(offs) - 1
        text = buf.tobytes().decode("utf-8", errors="replace")
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        lead = np.flatnonzero((buf & 0xC0) != 0x80)  # the byte with which each character begins
        if len(lead) != len(points):  # no UTF-8: what cannot be read is a replacement character
            fixed = [buf[a:b].tobytes().decode("utf-8", errors="replace").encode() for a, b in zip(offs[:-1], offs[1:], strict=True)]
            return self.count(np.frombuffer(b"".join(fixed), np.uint8), np.cumsum([0, *map(len, fixed)]))
        classes = self.classes[points]
        extra = np.zeros(rows, np.int64)
        row_char = np.searchsorted(lead, offs)  # each row's first character
        for s in self.special:
            at = text.find(s)
            while at >= 0:
                row = int(np.searchsorted(row_char, at, "right")) - 1
                if at + len(s) <= row_char[row + 1]:
                    classes[at : at + len(s)] = _CLASSES.index("end")
                    extra[row] += 1
                    at = text.find(s, at + len(s))
                else:
                    at = text.find(s, at + 1)
        end = _CLASSES.index("end")
        place = np.arange(len(points)) + np.searchsorted(row_char[1:], np.arange(len(points)), "right")
        all_classes = np.full(len(points) + rows, end, np.uint8)
        all_classes[place] = classes
        begin = split_marks(all_classes) & (all_classes != end)
        byte_at = np.empty(len(all_classes) + 1, np.int64)
        byte_at[row_char[1:] + np.arange(rows)] = offs[1:]
        byte_at[place] = lead
        byte_at[-1] = len(buf)
        edges = np.flatnonzero(begin | (all_classes == end))
        piece = np.flatnonzero(begin[edges])
        starts = byte_at[edges[piece]]
        ends = byte_at[edges[piece + 1]]
        keys, first, which = np.unique(span_hashes(prefix_hashes(buf), starts, ends), return_index=True, return_inverse=True)
        known = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        old = self.keys[known] == keys if len(self.keys) else np.zeros(len(keys), bool)
        n = np.empty(len(keys), np.int64)
        n[old] = self.counts[known[old]]
        new = ~old
        n[new] = self.counter.run(buf, starts[first[new]], (ends - starts)[first[new]])
        if len(self.keys) > MOST_PIECES:
            self.keys, self.counts = keys, n
        else:
            self.keys = np.concatenate((self.keys, keys[new]))
            self.counts = np.concatenate((self.counts, n[new]))
            order = np.argsort(self.keys, kind="stable")
            self.keys, self.counts = self.keys[order], self.counts[order]
        total = np.concatenate(([0], np.cumsum(n[which])))
        upto = np.searchsorted(starts, offs)
        return total[upto[1:]] - total[upto[:-1]] + extra


_COMPILED: dict[str, Tokenizer] = {}


def _run(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _COMPILED:
            _COMPILED[path] = Tokenizer(path)
        for rows, buf, offs in text_slices(batches):
            n = _COMPILED[path].count(buf, offs)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(np.diff(offs)), pa.array(n)], names=["doc_id", "n_bytes", "n_tokens"])

    return run


def token_counts(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of each row, for the vocabulary file at ``path`` on every worker."""
    kind = docs.schema[id_col].dataType.simpleString()
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return docs.mapInArrow(_run(path), f"doc_id {kind}, n_bytes long, n_tokens long")
