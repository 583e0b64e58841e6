"""Byte-pair encoding and decoding with a tokenization automaton.

The merge list is compiled once per Python worker. States are tokens: the state reached by an arc is
the token on that arc. Merge number k = (a, b) adds one gadget: the path "a then b" is cut and
replaced by an arc for the new token c. State c leaves like b did so far and is entered like a was,
so a gadget only stores its two parents; whether an arc x -> y exists is read off by undoing the
gadgets above x and y, newest first, and asking whether an older gadget cuts the path between them.
A word has exactly one accepted path whose arc labels spell it. It is found left to right: a tree of
the arc labels proposes the arcs that can leave a place, longest first, and the arc table tells which
of them continues the path. Decoding emits the arc labels.

The texts of a batch are split together, on their bytes, and each word met in them is looked up once.
Words keep their ids in a bounded memo. Texts that hold special tokens or characters which the split
by kinds does not know are encoded one by one.

Results for odd input: null text encodes to no ids; the text of a special token is that token, as
the tokenizers library has it; repeated rows are encoded each; extra columns play no part.
"""

from __future__ import annotations

import gc
import json
import re
import unicodedata
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Tokenizer

# Unicode versions differ on letters and digits from here on; such text is split by the library.
SETTLED = 0x558
UNSETTLED = re.compile(f"[{chr(SETTLED)}-\U0010ffff]")


def _of_category(initial: str) -> str:
    """The settled characters of the Unicode categories with this initial, for a character class."""
    return "".join(c for c in map(chr, range(SETTLED)) if unicodedata.category(c)[0] == initial)


# Fixed values of byte-level vocabularies: the pre-split pattern (with Unicode classes written out;
# the order of branches with different first characters is free, and words are tried first), and the
# printable stand-ins for bytes.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LETTER, DIGIT = _of_category("L"), _of_category("N")
PRE_SPLIT = rf" ?[{LETTER}]+| ?[{DIGIT}]+|'(?:[stmd]|re|ve|ll)| ?[^{SPACE}{LETTER}{DIGIT}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
# The same for bytes: kinds of settled characters (0: any other), and the lead byte from which on they may not be settled.
IS_SPACE = 3
KINDS = np.zeros(SETTLED, np.uint8)
for _kind, _members in enumerate((LETTER, DIGIT, SPACE), 1):
    KINDS[[bool(re.match(f"[{_members}]", chr(c))) for c in range(SETTLED)]] = _kind
TWO_BYTES, UNSETTLED_LEAD = 0xC0, 0xC0 | SETTLED >> 6

ID_BYTES = 4
ROWS_PER_BATCH = 512
# Memo tables only save time. An entry of words takes some 150 bytes, in every worker.
MEMO_ENTRIES = 230_000
LONG_WORD = 64
LONGEST = 256


def _byte_of() -> dict[str, int]:
    hidden = [b for b in range(256) if b not in set(PRINTABLE)]
    return {chr(b): b for b in PRINTABLE} | {chr(256 + n): b for n, b in enumerate(hidden)}


def piece_starts(raw: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Where the pieces of PRE_SPLIT start, and the end, in the UTF-8 bytes of settled rows; rows: where these start, and the end."""
    kind, size = KINDS[raw], len(raw)
    lead = np.flatnonzero(raw >= TWO_BYTES)
    kind[lead] = kind[lead + 1] = KINDS[(raw[lead] & 31).astype(np.int32) << 6 | raw[lead + 1] & 63]
    edge = np.zeros(size + 1, bool)
    edge[rows] = True
    starts = edge.copy()
    starts[1:-1] |= kind[1:] != kind[:-1]
    # the last of some white space stands apart, or with what follows it if it is a space
    after = np.flatnonzero((kind[1:] != IS_SPACE) & (kind[:-1] == IS_SPACE) & ~edge[1:-1]) + 1
    last = raw[after - 1]
    starts[after - 1 - (last >= 0x80)] = True
    starts[after[last == ord(" ")]] = False
    # short forms: an apostrophe that starts a piece, with the letters behind it
    mark = np.flatnonzero((raw == ord("'")) & starts[:-1])
    one, two = (raw[np.minimum(mark + k, size - 1)] for k in (1, 2))
    inside = ~edge[mark + 1]
    short = inside & np.isin(one, list(b"stmd"))
    longer = inside & ~edge[np.minimum(mark + 2, size)] & np.isin(one.astype(np.int32) << 8 | two, [int.from_bytes(x, "big") for x in (b"re", b"ve", b"ll")])
    starts[mark[short | longer] + 1] = False
    starts[mark[short] + 2] = True
    starts[mark[longer] + 3] = True
    return np.flatnonzero(starts)


class MergeAutomaton:
    """Arc table and suffix automaton for one merge list (pairs of byte strings, first merge first)."""

    def __init__(self, merges: Sequence[tuple[bytes, bytes]]):
        self.labels = [bytes([b]) for b in range(256)]
        self.left, self.right = list(range(256)), list(range(256))
        self.gadgets: dict[int, int] = {}
        self.span = 256 + len(merges)
        # per state, whether an arc leads on to another; answers found so far
        self._arcs: dict[int, dict[int, bool]] = {}
        self._answers = 0
        state_of = {label: s for s, label in enumerate(self.labels)}
        live = [True] * 256
        for first, second in merges:
            a, b, c = state_of[first], state_of[second], len(self.labels)
            if first + second in state_of:
                raise ValueError(f"two merges make {first + second!r}")
            state_of[first + second] = c
            self.labels.append(first + second)
            # a token that its own bytes never reach has no arc
            live.append(live[a] and live[b] and not self._cut(a, b, c))
            self.left.append(a)
            self.right.append(b)
            self.gadgets[a * self.span + b] = c
        self.lengths = [len(label) for label in self.labels]
        self.longest = max(self.lengths)
        self._prefixes(live)

    def _cut(self, x: int, y: int, bound: int) -> bool:
        """Whether a gadget older than the bound joins the end of x and the start of y."""
        gadgets, left, right, span = self.gadgets, self.left, self.right, self.span
        while True:
            c = gadgets.get(x * span + y)
            if c is not None and c < bound:
                return True
            if x < 256 and y < 256:
                return False
            if x > y:
                bound, x = x, right[x]
            else:
                bound, y = y + 1, left[y]

    def _leads(self, x: int, y: int) -> bool:
        """Whether there is an arc from x to y."""
        self._answers += 1
        if self._answers > MEMO_ENTRIES:
            self._answers = 0
            self._arcs.clear()
        return not self._cut(x, y, self.span)

    def _prefixes(self, live: list[bool]) -> None:
        """Label tree of nested tables; under LONGEST the longest arc whose label is a prefix of the way there, and per arc the next shorter."""
        root: dict = {LONGEST: -1}
        self.shorter = [-1] * len(self.labels)
        # a label's prefixes are filled in before it, as labels come in order of length
        for s in sorted(range(len(self.labels)), key=lambda s: self.lengths[s]):
            node, before = root, -1
            for byte in self.labels[s]:
                before = node[LONGEST]
                node = node.setdefault(byte, {LONGEST: before})
            if live[s]:
                self.shorter[s] = before
                node[LONGEST] = s
        self.tree = root

    def path(self, word: bytes) -> list[int]:
        """States of the one accepted path that spells the word.

        An accepted path to a place in the word is the only one that ends there, so a place from
        which no arc leads on is given up for good, and the search takes linear time.
        """
        tree, shorter, lengths, longest = self.tree, self.shorter, self.lengths, self.longest
        n, i, last = len(word), 0, -1
        out: list[int] = []
        given_up: set[int] = set()
        t = -1
        while i < n:
            if t < 0:
                node = tree
                for byte in word[i : i + longest]:
                    nxt = node.get(byte)
                    if nxt is None:
                        break
                    node = nxt
                t = node[LONGEST]
            if last >= 0:
                arcs = self._arcs.get(last)
                if arcs is None:
                    arcs = self._arcs[last] = {}
            while t >= 0:
                if not given_up or i + lengths[t] not in given_up:
                    if last < 0:
                        break
                    ok = arcs.get(t)
                    if ok is None:
                        ok = arcs[t] = self._leads(last, t)
                    if ok:
                        break
                t = shorter[t]
            if t >= 0:
                out.append(t)
                i += lengths[t]
                last, t = t, -1
                continue
            while t < 0:
                if not out:
                    raise ValueError(f"no path spells {word!r}")
                given_up.add(i)
                back = out.pop()
                i -= lengths[back]
                last, t = out[-1] if out else -1, shorter[back]
        return out


def _bytes_of(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a large string or binary array in a row, where each value starts in them, and the end."""
    _, places, data = values.buffers()
    places = np.frombuffer(places, np.int64, len(values) + 1, values.offset * 8) if len(values) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[places[0] : places[-1]] if data else np.zeros(0, np.uint8)
    return raw, places - places[0]


class _Memo(dict):
    """Results of a function for keys met twice, found by plain lookup; those met once wait in a table of their own.

    Each table holds so many entries at most. A full table of waiting keys starts again empty; from a
    full memo the older half goes back to wait.
    """

    def __init__(self, make: Callable[[bytes | str], bytes], entries: int):
        self.make, self.entries, self.once = make, entries, {}

    def __missing__(self, key: bytes | str) -> bytes:
        out = self.once.get(key)
        if out is None:
            out = self.make(key)
            if len(key) <= LONG_WORD:
                if len(self.once) >= self.entries:
                    self.once.clear()
                self.once[key] = out
            return out
        if len(self) >= self.entries:
            self.once = dict(islice(self.items(), -(-self.entries // 2)))
            for old in self.once:
                del self[old]
        self[key] = out
        self.once.pop(key, None)
        return out


class Codec:
    """A tokenizer file as automaton: text to packed ids (unsigned 32 bit, little-endian) and back."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = _byte_of()
        raw = lambda token: bytes(byte_of[c] for c in token)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.automaton = MergeAutomaton([(raw(a), raw(b)) for a, b in pairs])
        vocab = {raw(token): i for token, i in spec["model"]["vocab"].items()}
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.packed = [vocab[label].to_bytes(ID_BYTES, "little") for label in self.automaton.labels]
        self.special = {text: i.to_bytes(ID_BYTES, "little") for text, i in special.items()}
        self.emit = {i: label for label, i in vocab.items()} | {i: text.encode() for text, i in special.items()}
        self.split_special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.pre_split = re.compile(PRE_SPLIT)
        self.open_blank = re.compile(rf" (?:[{SPACE}]|\Z)")
        # the library splits only, so it gets no vocabulary to hold in memory
        bare = {**spec, "added_tokens": [], "post_processor": None, "model": {"type": "BPE", "vocab": {}, "merges": []}}
        self.split_as_library = Tokenizer.from_str(json.dumps(bare)).pre_tokenizer.pre_tokenize_str
        self.pieces = _Memo(self._piece, MEMO_ENTRIES)
        self.chunks = _Memo(self._chunk, MEMO_ENTRIES // 4)

    def _piece(self, piece: bytes) -> bytes:
        return b"".join([self.packed[s] for s in self.automaton.path(piece)])

    def _chunk(self, chunk: str) -> bytes:
        return self.pieces_of(" " + chunk)

    def pieces_of(self, text: str) -> bytes:
        if text.isascii() or not UNSETTLED.search(text):
            parts = self.pre_split.findall(text)
        else:
            parts = [text[a:b] for _, (a, b) in self.split_as_library(text)]
        return b"".join(map(self.pieces.__getitem__, map(str.encode, parts)))

    def _plain(self, text: str) -> bytes:
        # Where no space meets other white space, the pre-split never crosses the place before a
        # space. So a text with unsettled characters falls into chunks whose ids are remembered as a
        # whole, and the library splits those that hold such a character.
        if text.isascii() or not UNSETTLED.search(text) or self.open_blank.search(text):
            return self.pieces_of(text)
        first, *rest = text.split(" ")
        return self.pieces_of(first) + b"".join(map(self.chunks.__getitem__, rest))

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.split_special or not self.split_special.search(text):
            return self._plain(text)
        out, at = [], 0
        for m in self.split_special.finditer(text):
            out += [self._plain(text[at : m.start()]), self.special[m.group()]]
            at = m.end()
        return b"".join([*out, self._plain(text[at:])])

    def _apart(self, raw: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Which rows of the UTF-8 bytes are to be encoded one by one."""
        out, whole = np.zeros(len(rows) - 1, bool), raw.tobytes()
        out[np.searchsorted(rows, np.flatnonzero(raw >= UNSETTLED_LEAD), side="right") - 1] = True
        for token in map(str.encode, self.special):
            at = whole.find(token)
            while at >= 0:
                row = np.searchsorted(rows, at, side="right") - 1
                # not what only two rows side by side make
                out[row] |= at + len(token) <= rows[row + 1]
                at = whole.find(token, at + 1)
        return out

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """What encode gives for each text; words are looked up once for all texts."""
        texts = texts.fill_null("").cast(pa.large_string())
        texts.validate(full=True)
        raw, rows = _bytes_of(texts)
        apart = self._apart(raw, rows)
        if apart.any():
            plain = iter(self.encode_all(texts.filter(pa.array(~apart))))
            return [self.encode(text.as_py()) if alone else next(plain) for text, alone in zip(texts, apart)]
        if not len(raw):
            return [b""] * len(texts)
        starts = piece_starts(raw, rows)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(raw)])
        words = pieces.dictionary_encode()
        # a NumPy array of objects is much faster than to_pylist here
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = pa.array(list(map(self.pieces.__getitem__, distinct)), pa.large_binary())
        ids, ends = _bytes_of(known.take(words.indices))
        ends = ends[np.searchsorted(starts, rows)].tolist()
        return [ids[a:b].tobytes() for a, b in zip(ends, ends[1:])]

    def decode(self, ids: bytes | None) -> str:
        if not ids:
            return ""
        return b"".join(map(self.emit.__getitem__, memoryview(ids).cast("I"))).decode("utf-8", errors="replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One compiled automaton per worker and file."""
    out = Codec(path)
    # the automaton stays as it is and holds no garbage: collections need not walk it again and again
    gc.collect()
    gc.freeze()
    return out


def _mapped(df: DataFrame, source: str, out: str, kind: str, keep: Sequence[str], mapping) -> DataFrame:
    """Replace one column by its mapped values; the kept columns pass unchanged."""
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField(out, T._parse_datatype_string(kind))])
    arrow_kind = pa.binary() if kind == "binary" else pa.string()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = mapping()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_PER_BATCH):
                part = batch.slice(at, ROWS_PER_BATCH)
                made = pa.array(apply(part.column(source)), arrow_kind)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), made], names=[*keep, out])

    return df.select(*dict.fromkeys([*keep, source])).mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, text: str = "text", keep: Sequence[str] = ("doc_id",), out: str = "ids") -> DataFrame:
    """The kept columns and the packed ids of the whole text (null and empty texts: no ids)."""
    return _mapped(docs, text, out, "binary", keep, lambda: codec(path).encode_all)


def decode(encoded: DataFrame, path: str, ids: str = "ids", keep: Sequence[str] = ("doc_id",), out: str = "text") -> DataFrame:
    """The kept columns and the text that the packed ids spell (no ids: empty text)."""
    return _mapped(encoded, ids, out, "string", keep, lambda: lambda column: [*map(codec(path).decode, column.to_pylist())])
