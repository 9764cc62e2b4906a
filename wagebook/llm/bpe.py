"""BPE encoding by backtracking over longest matches, and decoding by an offset table.

An Aho-Corasick automaton gives the longest token at a position. A sequence of tokens is what BPE's merges give exactly
when each token is its own encoding and each neighbouring pair is compatible: merging across its border is never due
before the tokens themselves are made. The encoder takes the longest token that is compatible with the last one, falls
back to shorter ones, and steps back where none is left; positions found dead are not tried again, so time is linear.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END = "\n"  # stands for the end-of-word suffix; no byte is written with it
CACHE = 400_000


def byte_letters() -> list[str]:
    """The letter that byte-level BPE writes each byte with: printable Latin-1 as it is, the rest from U+0100 on."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(rest)) for b in range(256)]


class WordBPE:
    """A tokenizer file with words cut by a pattern, byte letters, and an end-of-word suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, (split, _) = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        self.suffix = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        # Letters and numbers as the file's pattern has them; white space as Unicode's White_Space.
        space = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
        self.pieces = regex.compile(split["pattern"]["Regex"].replace(r"\s", space))
        self.marks = re.compile("(" + "|".join(re.escape(s) for s in self.special) + ")")
        self.letters = byte_letters()
        written = lambda t: t[: -len(self.suffix)] + END if t.endswith(self.suffix) else t
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        # Own numbers: base symbols, then merges in order. A merge that makes a token again is no new token.
        made = {a + b for a, b in pairs}
        base = [t for t in self.vocab if t not in self.special and t not in made]
        self.tokens, self.parts, self.merge = [written(t) for t in base], [(i, i) for i in range(len(base))], {}
        own = {t: i for i, t in enumerate(base)}
        for a, b in pairs:
            if a + b not in own:
                own[a + b] = len(self.tokens)
                self.tokens.append(written(a + b))
                self.parts.append((own[a], own[b]))
            self.merge.setdefault((own[a], own[b]), own[a + b])
        self.ids = np.array([self.vocab[t] for t in own], dtype="<u4")
        self.pairs: dict[tuple[int, int], bool] = {}
        number = {t: i for i, t in enumerate(self.tokens)}
        self.longest = ahocorasick.Automaton()
        self.shorter = [-1] * len(self.tokens)
        for t, i in number.items():
            self.longest.add_word(t, i)
            for n in range(len(t) - 1, 0, -1):
                if (k := number.get(t[:n])) is not None:
                    self.shorter[i] = k
                    break
        self.longest.make_automaton()
        self.reach = max(map(len, self.tokens))
        self.cache: dict[str, bytes] = {}
        # Offset table over token texts, each followed by the space that parts tokens.
        texts = [b""] * (1 + max(max(self.vocab.values()), *self.special.values()))
        for t, i in [*self.vocab.items(), *self.special.items()]:
            texts[i] = t.encode() + b" "
        self.blob = np.frombuffer(b"".join(texts), dtype=np.uint8)
        self.offsets = np.cumsum([0, *map(len, texts)])

    def compatible(self, a: int, b: int) -> bool:
        """Whether merges leave the border between tokens a and b alone. Results are kept as a table."""
        if (known := self.pairs.get((a, b))) is not None:
            return known
        left, right, limit, good = a, b, len(self.tokens), True
        while True:
            made = self.merge.get((left, right))
            if made is not None and made < limit:
                good = False
                break
            # Undo the later of the two tokens' merges; what was merged before it stays a limit.
            in_left, in_right = self.parts[left][1] != left, self.parts[right][0] != right
            if in_left and (left > right or not in_right):
                limit, left = left, self.parts[left][1]
            elif in_right:
                limit, right = right + 1, self.parts[right][0]
            else:
                break
        if len(self.pairs) > 4 * CACHE:
            self.pairs.clear()
        self.pairs[a, b] = good
        return good

    def longest_at(self, word: str, at: int) -> int:
        """The longest token that begins at a place of word. Only as much of the word is looked at as a token can have, as the
        automaton takes time for all it is given."""
        return next(self.longest.iter_long(word[at : at + self.reach]))[1]

    def encode_piece(self, piece: str) -> list[int]:
        """Own numbers of the tokens of one piece."""
        word = "".join(self.letters[b] for b in piece.encode()) + END
        n, at, out = len(word), 0, []
        alive = bytearray(b"\1") * (n + 1)
        alive[n - 1] = 0  # the last letter and the suffix are one symbol
        token = self.longest_at(word, 0)
        while at < n:
            last = out[-1] if out else -1
            while True:
                end = at + len(self.tokens[token])
                if alive[end] and (last < 0 or self.compatible(last, token)):
                    out.append(token)
                    at = end
                    if at < n:
                        token = self.longest_at(word, at)
                    break
                if self.shorter[token] >= 0:
                    token = self.shorter[token]
                    continue
                alive[at] = 0
                out.pop()
                at -= len(self.tokens[last])
                token = last
                break
        return out

    def _piece(self, piece: str) -> bytes:
        got = self.cache.get(piece)
        if got is None:
            got = self.ids[self.encode_piece(piece)].tobytes()
            if len(self.cache) > CACHE:
                self.cache.clear()
            if len(piece) < 64:
                self.cache[piece] = got
        return got

    @staticmethod
    def _normal(text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if "Σ" in text:  # a final sigma is lowered as any other
                return "".join(map(str.lower, text))
        return text.lower()

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text."""
        out = []
        for k, part in enumerate(self.marks.split(text) if "<|" in text else [text]):
            if k % 2:
                out.append(np.uint32(self.special[part]).tobytes())
            else:
                get, pieces = self.cache.get, self.pieces.findall(self._normal(part))
                out += [get(p) or self._piece(p) for p in pieces]
        return np.frombuffer(b"".join(out), dtype="<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        """Token texts parted by spaces, in UTF-8."""
        starts, ends = self.offsets[ids], self.offsets[ids.astype(np.int64) + 1]
        sizes = ends - starts
        total = int(sizes.sum())
        if not total:
            return b""
        at = np.arange(total) + np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
        return self.blob[at].tobytes()[:-1]


_LOADED: dict[str, WordBPE] = {}


def loaded(path: str) -> WordBPE:
    """One tokenizer per worker process."""
    if path not in _LOADED:
        _LOADED[path] = WordBPE(path)
    return _LOADED[path]


def encoded(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids (little-endian unsigned 32-bit integers) and decoded (UTF-8) of each whole text.

    A null text is empty; an empty text has no tokens. path: the tokenizer file; each executor opens its own, by default
    where its own Python finds the public one. Texts are taken one by one, so memory goes with the longest text.
    Repeated rows, ids and null ids are encoded as they come; no rows give no rows; other columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path or default_path())
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                ids = [bpe.encode(t.as_py() or "") for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary()), pa.array([bpe.decode(x) for x in ids], pa.binary())], ["id", "n_tokens", "ids", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), text_col).mapInArrow(run, f"id {kind}, n_tokens long, ids binary, decoded binary")
    return out.withColumnRenamed("id", id_col)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(spark, docs: DataFrame, path: str | None = None) -> DataFrame:
    out = encoded(docs, path)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
