"""BPE encoding as a streaming transducer with bounded lookahead, and incremental decoding.

How far one has to look ahead follows from the merge list. ``reach`` of a token is a number
of symbols such that a token that starts at s is certain once s + reach symbols of its word
are read, whatever follows. Going through the rules (x, y) in order, reach(x) and reach(xy)
become at least size(x) + reach(y), and reach(xy) at least reach(x):

* two words that agree on their first m symbols agree, after each rule, on all tokens with
  s + reach <= m. A token that the rule makes has both its parts before; one that it leaves
  alone could only be joined with a right neighbour, which agrees too. What is to the left of
  s is the merging of the same symbols, as nothing has crossed s.

So a word is read in windows: the window is merged, tokens that are certain are emitted, the
rest stays. The tokens behind an emitted one are those of the rest alone. Working
memory is two lookaheads, however long the word; shorter words are one window.

A vocabulary is read from a tokenizer file of byte-level BPE with a mark at ends of words,
with all bytes among its tokens. Others are refused, as are lists with a rule before one that
makes its parts. Splitting into words is the file's own (its normaliser and pre-tokeniser,
by the library), for a run without white space at a time, which is what they never cross.

Decoding goes id by id. What the library's decode gives for a file without a decoder, the
tokens with a space between them, keeps one bit of state; the text itself keeps the bytes of
an unfinished character, and turns bytes that are no UTF-8 into U+FFFD.

Rules: a NULL text counts as empty; an empty text has no ids and decodes to the empty text.
Special tokens in a text get their ids, as in the library. Each row is encoded, repeated ones
alike; other columns are not looked at. Ids outside the vocabulary decode to nothing.
"""

from __future__ import annotations

import codecs
import json
import re
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_batches, per_worker, spread, texts

#: Runs without white space that an encoder remembers, and the longest of them.
KNOWN_RUNS, RUN_CHARS = 700_000, 64
#: Characters given to the pre-tokeniser at once, if there is a place to cut.
WINDOW_CHARS = 1 << 16
_NONE = 1 << 62
#: Between these characters a word always ends, whatever stands around.
_CUT = re.compile(r"(?<=[0-9])(?=[0-9])|(?<=[a-z0-9])(?=[!-&(-/:-@\[-`{-~])")
#: White space to Python that is none to the library.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_RUNS = re.compile("[^\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+")
#: Letters that normalising leaves as they are but for their case, and at most one mark. The
#: library splits such a run in these two (the tests ask it about every character).
_SIMPLE = re.compile("([A-Za-z\\u00c0-\\u00d6\\u00d8-\\u00f6\\u00f8-\\u012f\\u0132-\\u0148\\u014a-\\u017e]+)([.,;:!?]?)")


def _byte_letters() -> dict[int, str]:
    """The letter by which byte-level vocabularies write each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


class Vocabulary:
    """Tokens, merge rules, and how far each token has to look ahead."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        model, self.suffix = config["model"], config["model"].get("end_of_word_suffix") or ""
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges") if model.get(k)]
        if model["type"] != "BPE" or odd or not self.suffix or config.get("post_processor"):
            raise ValueError("only byte-level BPE with a mark at ends of words is known")
        ids, letters = model["vocab"], _byte_letters()
        missing = [c for c in letters.values() if c not in ids or c + self.suffix not in ids]
        if missing:
            raise ValueError(f"{len(missing)} bytes have no token")
        added = {t["content"]: t["id"] for t in config["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in config["added_tokens"]):
            raise ValueError("special tokens that look at their surroundings are not known")
        self.added, self.byte_of = added, {c: b for b, c in letters.items()}
        self.inner = [ids[letters[b]] for b in range(256)]
        self.final = [ids[letters[b] + self.suffix] for b in range(256)]
        self.tokens = {i: t for t, i in (ids | added).items()}
        self.size = {i: 1 for i in (*self.inner, *self.final)}
        self.reach = dict(self.size)
        self.rules: dict[int, int] = {}
        made: set[int] = set()
        for rank, rule in enumerate(model["merges"]):
            left, right = rule.split(" ") if isinstance(rule, str) else rule
            a, b, ab = ids[left], ids[right], ids[left + right]
            if a not in self.size or b not in self.size or ab in made:
                raise ValueError(f"rule {rank} comes before one that makes its parts, or makes a token again")
            self.rules[a << 20 | b] = rank << 20 | ab
            made.add(ab)
            self.size[ab] = self.size[a] + self.size[b]
            ahead = max(self.reach[a], self.size[a] + self.reach[b])
            self.reach[a] = max(self.reach[a], ahead)
            self.reach[ab] = max(self.reach.get(ab, 0), ahead)
        self.lookahead = max(self.reach.values())
        # The library's splitting alone: its file with an empty model.
        empty = {"type": "BPE", "vocab": {}, "merges": []}
        self.splitting = json.dumps(config | {"model": empty, "added_tokens": []})
        self.name = f"{path}:{len(ids)}:{len(self.rules)}"

    def surface(self, token: int) -> bytes:
        """The bytes that a token stands for; the end of a word is a space."""
        text = self.tokens[token]
        if text in self.added:
            return text.encode()
        word, end = (text.removesuffix(self.suffix), b" ") if text.endswith(self.suffix) else (text, b"")
        return bytes(self.byte_of[c] for c in word) + end


def merge(symbols: list[int], rules: dict[int, int]) -> list[int]:
    """Merge, the earliest rule first, of its places the leftmost."""
    rule = rules.get
    pairs = [rule(a << 20 | b, _NONE) for a, b in zip(symbols, symbols[1:])]
    n = len(pairs)
    while n:
        best = min(pairs)
        if best == _NONE:
            break
        k, token = pairs.index(best), best & 0xFFFFF
        symbols[k] = token
        del symbols[k + 1], pairs[k]
        n -= 1
        if k < n:
            pairs[k] = rule(token << 20 | symbols[k + 1], _NONE)
        if k:
            pairs[k - 1] = rule(symbols[k - 1] << 20 | token, _NONE)
    return symbols


class Transducer:
    """Emits the ids of a word, given as bytes, while it is read."""

    def __init__(self, vocabulary: Vocabulary, lookahead: int | None = None):
        self.vocabulary = vocabulary
        self.window = 2 * (vocabulary.lookahead if lookahead is None else lookahead)

    def word(self, word: bytes) -> list[int] | Iterator[int]:
        v = self.vocabulary
        if len(word) > self.window:
            return self._long(word)
        symbols = [v.inner[b] for b in word]
        symbols[-1] = v.final[word[-1]]
        return merge(symbols, v.rules)

    def _long(self, word: bytes) -> Iterator[int]:
        v, begin = self.vocabulary, 0
        while len(word) - begin > self.window:
            at, end = begin, begin + self.window
            for token in merge([v.inner[b] for b in word[begin:end]], v.rules):
                if at + v.reach[token] > end:
                    break
                yield token
                at += v.size[token]
            begin = at
        symbols = [v.inner[b] for b in word[begin:]]
        symbols[-1] = v.final[word[-1]]
        yield from merge(symbols, v.rules)


class Splitter:
    """Words of a run without white space, as bytes; special tokens by id."""

    def __init__(self, vocabulary: Vocabulary):
        from tokenizers import Tokenizer

        library = Tokenizer.from_str(vocabulary.splitting)
        self.normal, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.added, self.byte = vocabulary.added, {ord(c): chr(b) for b, c in _byte_letters().items()}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None

    def words(self, run: str) -> Iterator[bytes | int]:
        for part in self.special.split(run) if self.special else [run]:
            if part in self.added:
                yield self.added[part]
                continue
            text, at = self.normal(part), 0
            while at < len(text):
                cut = _CUT.search(text, at + WINDOW_CHARS) if len(text) - at > WINDOW_CHARS else None
                end = cut.start() if cut else len(text)
                for word, _ in self.split(text[at:end]):
                    yield word.translate(self.byte).encode("latin-1")
                at = end


class Encoder(dict):
    """Encodes batches; remembers the code of short runs, by which their ids are found."""

    def __init__(self, vocabulary: Vocabulary):
        self.transducer, self.splitter = Transducer(vocabulary), Splitter(vocabulary)
        self.final = vocabulary.final
        self._forget()

    def _forget(self) -> None:
        self.clear()
        self.ids, self.ends = array("i"), array("q", [0])
        self._forget_long()

    def _forget_long(self) -> None:
        self.long_ids, self.long_ends = array("i"), array("q")

    def _add(self, run: str, ids: Iterator[int] | list[int]) -> int:
        self[run] = code = len(self.ends) - 1
        self.ids.extend(ids)
        self.ends.append(len(self.ids))
        return code

    def run(self, run: str) -> Iterator[int]:
        """The ids of a run without white space."""
        for word in self.splitter.words(run):
            yield from (word,) if isinstance(word, int) else self.transducer.word(word)

    def __missing__(self, run: str) -> int:
        if len(run) > RUN_CHARS:
            self.long_ids.extend(self.run(run))
            self.long_ends.append(len(self.long_ids))
            return -len(self.long_ends)
        simple = _SIMPLE.fullmatch(run)
        if simple is None:
            return self._add(run, self.run(run))
        letters, mark = simple.groups()
        lower = letters.lower()
        if lower == run:
            return self._add(run, self.transducer.word(run.encode()))
        code = self[lower]
        if not mark:
            self[run] = code
            return code
        return self._add(run, [*self.ids[self.ends[code] : self.ends[code + 1]], self.final[ord(mark)]])

    def encode(self, rows: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each text)."""
        if len(self) > KNOWN_RUNS:
            self._forget()
        codes = array("q")
        ends = [0]
        for text in rows:
            codes.extend(map(self.__getitem__, _RUNS.findall(text) if _SEPARATORS.search(text) else text.split()))
            ends.append(len(codes))
        code, n_known = np.array(codes, np.int64), len(self.ends) - 1
        flat = np.concatenate((np.array(self.ids, np.int32), np.array(self.long_ids, np.int32)))
        bounds = np.concatenate((np.array(self.ends, np.int64), np.array(self.long_ends, np.int64) + len(self.ids)))
        self._forget_long()
        code = np.where(code < 0, n_known - 1 - code, code)
        sizes = np.diff(bounds)[code]
        before = np.concatenate(([0], np.cumsum(sizes)))
        return flat[spread(bounds[:-1][code], sizes)], np.diff(before[ends])


class TokenDecoder:
    """Tokens with a space between them; state: whether one has been there."""

    def __init__(self, vocabulary: Vocabulary):
        self.tokens, self.begun = vocabulary.tokens, False

    def feed(self, ids: Sequence[int]) -> str:
        out = " ".join([self.tokens[i] for i in ids if i in self.tokens])
        gap = " " if self.begun and out else ""
        self.begun |= bool(out)
        return gap + out


class TextDecoder:
    """The text; state: the bytes of a character that has not ended."""

    def __init__(self, vocabulary: Vocabulary):
        self.surfaces = per_worker(("surfaces", vocabulary.name), lambda: {i: vocabulary.surface(i) for i in vocabulary.tokens})
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Sequence[int]) -> str:
        return self.state.decode(b"".join(self.surfaces.get(i, b"") for i in ids))

    def finish(self) -> str:
        return self.state.decode(b"", True)


def _encoded(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, key: str, check: bool) -> Iterator[pa.RecordBatch]:
    encoder = per_worker(("transducer", vocabulary.name), lambda: Encoder(vocabulary))
    for batch in as_batches(batches):
        ids, counts = encoder.encode(batch.column("text").to_pylist())
        ends = np.concatenate(([0], np.cumsum(counts)))
        lists = pa.ListArray.from_arrays(ends.astype(np.int32), pa.array(ids, pa.int32()))
        columns, names = [batch.column(key), pa.array(counts), lists], [key, "n_tokens", "ids"]
        if check:
            decoded = [TokenDecoder(vocabulary).feed(ids[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            columns, names = [*columns, pa.array(decoded, pa.string())], [*names, "decoded"]
        yield pa.RecordBatch.from_arrays(columns, names)


def encode_documents(docs: DataFrame, vocabulary: Vocabulary, key: str = "doc_id", decoded: bool = False) -> DataFrame:
    """``key``, n_tokens and ids of every row; with ``decoded``, the ids decoded as the library does."""
    rows = texts(docs, key)
    schema = f"`{key}` {rows.schema[key].dataType.simpleString()}, n_tokens long, ids array<int>"
    schema += ", decoded string" if decoded else ""
    return rows.mapInArrow(lambda b: _encoded(b, vocabulary, key, decoded), schema)


def _decoded(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, key: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for ids in batch.column("ids").to_pylist():
            decoder = TextDecoder(vocabulary)
            out.append(decoder.feed([i for i in ids or () if i is not None]) + decoder.finish())
        yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(out, pa.string())], [key, "text"])


def decode_documents(encoded: DataFrame, vocabulary: Vocabulary, key: str = "doc_id") -> DataFrame:
    """``key`` and text of every row of ids; every word ends with a space, as the vocabulary has it."""
    rows = encoded.select(key, "ids")
    schema = f"`{key}` {rows.schema[key].dataType.simpleString()}, text string"
    return rows.mapInArrow(lambda b: _decoded(b, vocabulary, key), schema)


def digest(encoded: DataFrame, key: str = "doc_id") -> DataFrame:
    """The contract's columns: digests of the decimal ids and of the decoded text."""
    joined = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return encoded.select(
        key, "n_tokens", F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
