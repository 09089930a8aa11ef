"""BPE as a streaming transducer with bounded lookahead, and an incremental decoder.

A token sequence is the BPE encoding of its text exactly when every two neighbours are the
encoding of their own concatenation. So each prefix of a unit has one last token, found
from the last tokens of shorter prefixes, and a token is stable once the prefixes that any
continuation can build on share it: those within the longest token of the merge list.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsfeat.llm.pieces import _byte_letters
from newsfeat.session import ship_package

END_OF_WORD = "</w>"
#: How the vocabulary's tokenizer cuts text into units (a fixed value).
UNIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: White space as Unicode defines it.
WHITE = re.compile("[\t-\r \x85\xa0  -     　]+")
#: str.split also cuts at these.
SEPARATORS = re.compile("[\x1c-\x1f]")
#: Words kept in a generation of the worker's table, and pair verdicts kept.
GENERATION, PAIRS = 700_000, 1_000_000
LONGEST_WORD = 64
NONE = 1 << 30


class Merges:
    """The merge list and what follows from it."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.rank = {tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.letters = _byte_letters()
        symbols = {t: self.size(t) for t in self.vocab}
        #: No token is longer, so no continuation reaches further back.
        self.lookahead = max(symbols.values())
        self._pairs: dict[tuple[str, str], bool] = {}
        #: Tokens that are the encoding of their own text; no others ever come out.
        self.sound = {t for t in self.vocab if self.merge(self.symbols(t)) == [t]}

    @staticmethod
    def size(token: str) -> int:
        """Symbols of a token; the end of word belongs to the last one."""
        bare = token.removesuffix(END_OF_WORD)
        return len(bare) if bare else 1

    @staticmethod
    def symbols(token: str) -> list[str]:
        if token.endswith(END_OF_WORD) and len(token) > len(END_OF_WORD):
            bare = token[:-len(END_OF_WORD)]
            return [*bare[:-1], bare[-1] + END_OF_WORD]
        return list(token)

    def merge(self, symbols: list[str]) -> list[str]:
        """The definition: merge the leftmost pair of lowest rank until none is left."""
        get, parts = self.rank.get, list(symbols)
        while len(parts) > 1:
            ranks = [get(p, NONE) for p in zip(parts, parts[1:])]
            best = min(ranks)
            if best == NONE:
                break
            at = ranks.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def neighbours(self, left: str, right: str) -> bool:
        """Whether left, right is the encoding of their concatenation."""
        out = self._pairs.get((left, right))
        if out is None:
            if len(self._pairs) >= PAIRS:
                self._pairs.clear()
            out = self._pairs[left, right] = self.merge(self.symbols(left) + self.symbols(right)) == [left, right]
        return out


class Transducer:
    """Symbols of one unit in, tokens out as soon as they are stable. Memory: a few lookaheads of symbols."""

    def __init__(self, merges: Merges):
        self.m = merges
        #: last[i]: last token of the first i kept symbols; last[0]: the token emitted before them
        self.base, self.text, self.last, self.held = 0, "", [""], None

    def _step(self, ending: str) -> None:
        """Find the last token of the prefix that ends with the newest symbol."""
        m, text, last = self.m, self.text, self.last
        n = len(text)
        for k in range(min(n, m.lookahead), 0, -1):
            token = text[n - k:] + ending
            if token in m.sound:
                before = last[n - k]
                if before == "" and n - k + self.base > 0:
                    continue
                if before == "" or m.neighbours(before, token):
                    last.append(token)
                    return
        raise ValueError("the vocabulary cannot spell a symbol")

    def _path(self, node: int) -> list[str]:
        """Tokens from the kept start to a node, backwards from its last token."""
        out = []
        while node > 0:
            out.append(self.last[node])
            node -= Merges.size(self.last[node])
        return out[::-1]

    def feed(self, letter: str) -> list[str]:
        """One more letter of the unit; the newest one waits, for it may be the last."""
        ready: list[str] = []
        if self.held is not None:
            self.text += self.held
            self._step("")
            if len(self.text) >= 4 * self.m.lookahead:
                ready = self._stable()
        self.held = letter
        return ready

    def _stable(self) -> list[str]:
        """Emit what all prefixes within the lookahead share and forget it."""
        n = len(self.text)
        nodes = set(range(n - self.m.lookahead + 1, n + 1))
        while len(nodes) > 1:
            top = max(nodes)
            nodes.discard(top)
            nodes.add(top - Merges.size(self.last[top]))
        (node,) = nodes
        if node <= 0:
            return []
        # the shared last token stays as the left neighbour of what follows
        out = self._path(node)
        keep = self.last[node]
        self.text = self.text[node:]
        self.last = [keep, *self.last[node + 1:]]
        self.base += node
        return out

    def finish(self) -> list[str]:
        """The rest of the unit's tokens; the transducer is ready for the next unit."""
        self.text += self.held or ""
        self._step(END_OF_WORD)
        out = self._path(len(self.text))
        self.__init__(self.m)
        return out


class StreamEncoder:
    """Text in chunks -> token strings; chunks may end anywhere."""

    def __init__(self, merges: Merges):
        self.m = merges
        self.transducer = Transducer(merges)
        names = "|".join(re.escape(s) for s in sorted(merges.special, key=len, reverse=True))
        self.special = re.compile(f"({names})") if names else None
        self.words: dict[str, str] = {}
        self.older: dict[str, str] = {}

    def unit_tokens(self, unit: str) -> Iterator[str]:
        """Tokens of one unit of text. Units within the window need no emission before their end."""
        letters = unit.encode().decode("latin-1").translate(self.m.letters)
        if len(letters) <= 4 * self.m.lookahead:
            yield from self._short(letters)
            return
        t = self.transducer
        for letter in letters:
            yield from t.feed(letter)
        yield from t.finish()

    def _short(self, text: str) -> list[str]:
        """The transducer's steps over a unit that its window holds whole."""
        sound, pairs, neighbours = self.m.sound, self.m._pairs, self.m.neighbours
        n, reach = len(text), self.m.lookahead
        last = [""] * (n + 1)
        for end in range(1, n + 1):
            tail = END_OF_WORD if end == n else ""
            for start in range(max(0, end - reach), end):
                token = text[start:end] + tail
                if token in sound:
                    if not start:
                        break
                    pair = last[start], token
                    fits = pairs.get(pair)
                    if neighbours(*pair) if fits is None else fits:
                        break
            else:
                raise ValueError("the vocabulary cannot spell a symbol")
            last[end] = token
        out = []
        while n:
            out.append(last[n])
            n -= Merges.size(last[n])
        return out[::-1]

    def _word(self, word: str) -> str:
        """Decimal ids of a word, kept while they fit the table."""
        out = self.older.get(word)
        if out is None:
            units = UNIT.findall(word)
            if len(units) > 1:
                out = " ".join([self.words.get(u) or self._word(u) for u in units])
            else:
                out = " ".join([str(self.m.vocab[t]) for u in units for t in self.unit_tokens(u)])
        if len(word) <= LONGEST_WORD:
            if len(self.words) >= GENERATION:
                self.older, self.words = self.words, {}
            self.words[word] = out
        return out

    def _plain(self, text: str) -> list[str]:
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        words = WHITE.split(text) if SEPARATORS.search(text) else text.split()
        get = self.words.get
        return [get(w) or self._word(w) for w in words if w]

    def decimals(self, text: str) -> str:
        """All ids of a text, in decimal, joined by spaces."""
        if self.special is None or "<|" not in text:
            return " ".join(self._plain(text))
        out: list[str] = []
        for part in self.special.split(text):
            if part in self.m.special:
                out.append(str(self.m.special[part]))
            else:
                out += self._plain(part)
        return " ".join(out)

    def stream(self, chunks: Iterable[str]) -> Iterator[str]:
        """Decimal ids chunk by chunk; only the run since the last white space waits."""
        rest = ""
        for chunk in chunks:
            rest += chunk
            cut = max((m.start() for m in WHITE.finditer(rest)), default=0)
            if cut:
                ready, rest = rest[:cut], rest[cut:]
                if out := self.decimals(ready):
                    yield out
        if out := self.decimals(rest):
            yield out


class StreamDecoder:
    """Ids in, text out: bytes wait until they make whole characters; a word's end is a space."""

    def __init__(self, merges: Merges):
        self.m = merges
        self.bytes_of = {c: bytes([b]) for b, c in merges.letters.items()}
        self.names = {str(i): t for i, t in merges.tokens.items()}
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, token_id: int) -> str:
        token = self.m.tokens[token_id]
        if token in self.m.special:
            return self.utf8.decode(b"", True) + token
        ends = token.endswith(END_OF_WORD)
        data = b"".join(self.bytes_of[c] for c in token.removesuffix(END_OF_WORD))
        return self.utf8.decode(data + b" " * ends)

    def finish(self) -> str:
        return self.utf8.decode(b"", True)

    def spelled(self, decimals: str) -> str:
        """The tokens as written in the vocabulary, joined by spaces: what a tokenizer file without decoder gives."""
        return " ".join(map(self.names.__getitem__, decimals.split(" "))) if decimals else ""


_workers: dict[str, tuple[StreamEncoder, StreamDecoder]] = {}


def _worker(path: str) -> tuple[StreamEncoder, StreamDecoder]:
    if path not in _workers:
        merges = Merges(path)
        _workers[path] = StreamEncoder(merges), StreamDecoder(merges)
    return _workers[path]


def encode_digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256 per row; a null text is empty. Rows stay where they are."""
    ship_package(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    slim = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _worker(path)
        for batch in batches:
            sizes, digests, decoded = [], [], []
            for cell in batch.column("text"):
                ids = encoder.decimals(cell.as_py())
                sizes.append(ids.count(" ") + 1 if ids else 0)
                digests.append(hashlib.sha256(ids.encode()).hexdigest())
                decoded.append(hashlib.sha256(decoder.spelled(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()),
                 pa.array(decoded, pa.string())], ["key", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return slim.mapInArrow(run, schema).withColumnRenamed("key", key)


def encode_ids(docs: DataFrame, path: str, text: str = "text", out: str = "token_ids") -> DataFrame:
    """Add the ids of every text as array<int>; a null text has none."""
    ship_package(docs.sparkSession)
    names = [c for c in docs.columns if c != out]
    schema = docs.select(*names).withColumn(out, F.array().cast("array<int>")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, _ = _worker(path)
        for batch in batches:
            ids = [list(map(int, encoder.decimals(c.as_py() or "").split())) for c in batch.column(text)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.list_(pa.int32()))],
                                             [*batch.schema.names, out])

    return docs.select(*names).mapInArrow(run, schema)


def decode_ids(docs: DataFrame, path: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """Add the text of every array of ids; a null array is empty."""
    ship_package(docs.sparkSession)
    names = [c for c in docs.columns if c != out]
    schema = docs.select(*names).withColumn(out, F.lit("")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            decoder = _worker(path)[1]
            for cell in batch.column(ids):
                texts.append("".join([decoder.feed(i) for i in cell.as_py() or []]) + decoder.finish())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             [*batch.schema.names, out])

    return docs.select(*names).mapInArrow(run, schema)
