"""BPE encoding by backtracking over longest token matches, and decoding through an offset table.

A word is encoded from left to right. An Aho-Corasick automaton gives the longest token that starts at each place. A token is
taken if it may stand after the token before it: the pair is compatible if BPE, run on their joined text, would return just
these two. If it may not, the next shorter token at that place is tried; if none is left, the last token is given back. A
place that failed once is marked and not entered again, so the work is linear in the word's length. The result equals that
of applying merges in order of rank, as each prefix of a BPE encoding is the BPE encoding of its text.

Compatibility is decided by undoing the merges of both tokens along their common border; answers are kept in a bounded table.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

#: Fixed values of the byte-level alphabet: bytes that stand for themselves; the others get code points from 256 on, in order.
_PLAIN_BYTES = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
#: The last character of a word is moved to this private area; it stands for that character with the end-of-word mark.
_END = 0xE000
#: Letters that every Unicode version in use knows alike. Texts with others are normalised and cut into words by the
#: tokenizers library itself, so that its version of Unicode decides; encoding them is the same.
_SETTLED = regex.compile(r"[\x00-\u052F\u2010-\u2027\u2030-\u205E\u20A0-\u20BF\u3041-\u3096\u30A1-\u30FA\u4E00-\u9FA5\uAC00-\uD7A3]*")
#: Bounds of the tables in each worker; a full table is emptied.
WORD_TABLE, PAIR_TABLE = 200_000, 300_000


def byte_alphabet() -> list[str]:
    out, extra = [""] * 256, 256
    for b in range(256):
        if b in _PLAIN_BYTES_SET:
            out[b] = chr(b)
        else:
            out[b], extra = chr(extra), extra + 1
    return out


_PLAIN_BYTES_SET = frozenset(_PLAIN_BYTES)


class Tokenizer:
    """Reads a tokenizers file of this kind: BPE with an end-of-word suffix over byte-level words cut by a pattern."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        if model["type"] != "BPE" or not self.suffix or spec["decoder"] is not None:
            raise ValueError("a BPE file with an end-of-word suffix and no decoder is needed")
        texts = {i: t for t, i in model["vocab"].items()}
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        texts |= {i: t for t, i in self.special.items()}
        self.size = max(texts) + 1
        self.texts = [texts.get(i, "") for i in range(self.size)]
        vocab = {self._symbols(t): i for t, i in model["vocab"].items()}
        self.lengths = [0] * self.size
        for s, i in vocab.items():
            self.lengths[i] = len(s)
        # merges: token -> its two parts and rank; pairs: two tokens -> rank and merged token.
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        self.pairs: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            a, b = model["vocab"][left], model["vocab"][right]
            c = model["vocab"][left + right]
            if c in self.rank:
                raise ValueError(f"two merges make the token {left + right!r}")
            self.parts[c], self.rank[c], self.pairs[a, b] = (a, b), rank, c
        # Matches are read from the right, so that one pass yields for each start the longest token there.
        self.automaton = ahocorasick.Automaton()
        for s, i in vocab.items():
            self.automaton.add_word(s[::-1], i)
        self.automaton.make_automaton()
        self.shorter = [-1] * self.size
        for s, i in vocab.items():
            self.shorter[i] = next((vocab[s[:n]] for n in range(len(s) - 1, 0, -1) if s[:n] in vocab), -1)
        self.alphabet = byte_alphabet()
        self.table = {b: self.alphabet[b] for b in range(256)}
        self.byte_of = {c: b for b, c in enumerate(self.alphabet)}
        split = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        # The offset table: all token texts in one buffer, each followed by the blank that joins it to the next.
        blobs = [t.encode() + b" " for t in self.texts]
        self.offsets = np.zeros(self.size + 1, np.int64)
        np.cumsum([len(b) for b in blobs], out=self.offsets[1:])
        self.buffer = np.frombuffer(b"".join(blobs), np.uint8)
        self.decimal = [str(i) for i in range(self.size)]
        self.path, self._library = path, None
        self.words: dict[str, bytes] = {}
        self.compatible: dict[int, bool] = {}

    def _symbols(self, token: str) -> str:
        body = token.removesuffix(self.suffix)
        return body[:-1] + chr(_END + ord(body[-1])) if body != token and body else token

    def _fits(self, a: int, b: int) -> bool:
        """True if BPE leaves tokens a and b side by side: no merge across their border comes before those inside them."""
        pairs, rank, parts = self.pairs, self.rank, self.parts
        left, right, limit, fits = a, b, len(rank) + 1, True
        while True:
            merged = pairs.get((left, right))
            # A merge across the border happens if it ranks before the next merge that either side still needs.
            if merged is not None and rank[merged] < limit:
                fits = False
                break
            # Undo the later of the two sides' last merges; ties go left to right, so an equal rank on the left is undone last.
            ra, rb = rank.get(left, -1), rank.get(right, -1)
            if ra < 0 and rb < 0:
                break
            if ra > rb:
                limit = ra
                left = parts[left][1]
                # The border is now between the right half of the left side and the right side.
                if (m := pairs.get((left, right))) is not None and rank[m] < limit:
                    fits = False
                    break
            else:
                limit = rb
                right = parts[right][0]
                # While the right side's last merge waits, a merge of equal rank that starts further left would come first.
                if (m := pairs.get((left, right))) is not None and rank[m] < limit + 1:
                    fits = False
                    break
        if len(self.compatible) >= PAIR_TABLE:
            self.compatible.clear()
        self.compatible[a * self.size + b] = fits
        return fits

    def encode_symbols(self, word: str) -> list[int]:
        n = len(word)
        longest = [-1] * n
        lengths, shorter = self.lengths, self.shorter
        for end, token in self.automaton.iter(word[::-1]):
            if longest[n - 1 - end] < 0:  # of the matches at one place, the automaton gives the longest first
                longest[n - 1 - end] = token
        fits, known, size = self._fits, self.compatible.get, self.size
        out: list[int] = []
        at, dead, last = 0, bytearray(n + 1), -1
        token = longest[0]
        while True:
            while token >= 0:
                if not dead[at + lengths[token]]:
                    if last < 0:
                        break
                    fit = known(last * size + token)
                    if fit or fit is None and fits(last, token):
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at += lengths[token]
                if at == n:
                    break
                last, token = token, longest[at]
            else:
                if not out:
                    raise ValueError("a symbol of the word is not in the vocabulary")
                dead[at] = 1
                token = out.pop()
                at -= lengths[token]
                token, last = shorter[token], out[-1] if out else -1
        return out

    def _pieces(self, text: str) -> list[str]:
        if not _SETTLED.fullmatch(text):
            if self._library is None:
                self._library = tokenizers.Tokenizer.from_file(self.path)
            mapped = [p for p, _ in self._library.pre_tokenizer.pre_tokenize_str(self._library.normalizer.normalize_str(text))]
            return [bytes([self.byte_of[c] for c in p]).decode("utf-8", "surrogateescape") for p in mapped]
        text = unicodedata.normalize("NFC", text)
        # Letter by letter: the capital sigma is never taken as the end of a word.
        return self.pattern.findall(text.replace("Σ", "σ").lower())

    def _word(self, piece: str) -> bytes:
        mapped = piece.encode("utf-8", "surrogateescape").decode("latin-1").translate(self.table)
        ids = array("i", self.encode_symbols(mapped[:-1] + chr(_END + ord(mapped[-1])))).tobytes()
        if len(self.words) >= WORD_TABLE:
            self.words.clear()
        if len(piece) <= 64:
            self.words[piece] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        """The ids of a whole text, as int32; strings of special tokens in it become those tokens."""
        get, word, out = self.words.get, self._word, []
        sections = self.specials.split(text) if self.specials and "<|" in text else (text,)
        for k, section in enumerate(sections):
            if k % 2:
                out.append(np.array([self.special[section]], np.int32).tobytes())
            elif section:
                out.extend([get(p) or word(p) for p in self._pieces(section)])
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens' texts, joined by a blank, in UTF-8: ranges of the buffer, gathered through the offset table."""
        if not len(ids):
            return b""
        start = self.offsets[ids]
        lengths = self.offsets[np.asarray(ids) + 1] - start
        ends = np.cumsum(lengths)
        take = np.arange(ends[-1]) + np.repeat(start - (ends - lengths), lengths)
        return self.buffer[take][:-1].tobytes()


_loaded: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    """One tokenizer for each path and worker process."""
    if path not in _loaded:
        _loaded[path] = Tokenizer(path)
    return _loaded[path]


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, with_text: bool = False, keep: tuple = ()) -> DataFrame:
    """One row per row of docs: id, n_tokens, ids_sha256, decoded_sha256, on request token_ids and decoded, and the columns in keep.

    Null text is encoded as empty; empty text has no tokens and decodes to an empty text. Texts are encoded whole, one at a
    time, so memory is bounded by the longest text and the tables above. Only the named columns are read; an empty table gives an empty result, repeated rows give repeated rows. path names the
    tokenizer's file on every executor.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    small_batches(docs.sparkSession)
    kept = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    schema = f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", token_ids array<int>" * with_ids + ", decoded string" * with_text + kept

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for batch in batches:
            n, shas, decoded, ids_out, texts_out = [], [], [], [], []
            for value in batch.column(1):
                ids = t.encode(value.as_py() or "")
                listed = ids.tolist()
                back = t.decode(ids)
                n.append(len(listed))
                shas.append(hashlib.sha256(" ".join([t.decimal[i] for i in listed]).encode()).hexdigest())
                decoded.append(hashlib.sha256(back).hexdigest())
                if with_ids:
                    ids_out.append(ids)
                if with_text:
                    texts_out.append(back.decode("utf-8", "replace"))
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(shas, pa.string()), pa.array(decoded, pa.string())]
            if with_ids:
                columns.append(pa.array(ids_out, pa.list_(pa.int32())))
            if with_text:
                columns.append(pa.array(texts_out, pa.string()))
            columns += batch.columns[2:]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"] + ["token_ids"] * with_ids + ["decoded"] * with_text + [*keep])

    return docs.select(docs[id_col], docs[text_col], *[docs[c] for c in keep]).mapInArrow(run, schema)
