"""Token ids of whole texts by a public tokenizer, with the ids of words that recur kept in the worker.

A tokenizer that throws white space away and closes every word with a suffix gives each word the same ids wherever it
stands. For such a one, texts of plain letters, digits and signs are cut at white space; each distinct chunk of many texts is
looked up once and its ids are gathered for all its places. New chunks are cut into the tokenizer's words, of which only new
ones go to the tokenizers library (many at a time). Words with any other character go to the library as they are, and any
other tokenizer gets the whole text.

A file of ranks (a token in base64 and its rank a line) is a byte-level tokenizer of the tiktoken library; special tokens in
a text are ordinary text to it.
"""

from __future__ import annotations

import base64
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bounds of a worker's memory: at half of the pieces a new dictionary is begun, and the one before the last goes.
MAX_PIECES = 450_000
MAX_WORDS = 100_000
#: Characters whose chunks are looked up together.
TOGETHER = 1 << 20

# characters whose lower case and normal form are plain; after lower-casing only a-z and the letters from ß on remain
_PLAIN = re.compile(r"[\n\x20-\x7EÀ-ÖØ-öø-ÿ]*")
_SIGNS = re.compile(r"[^\sa-zß-öø-ÿ0-9](?:(?<=')(?:s|t|re|ve|m|ll|d)|[^\sa-zß-öø-ÿ0-9]*)")
_DIGIT = re.compile("[0-9]")
_SPACE = re.compile("[\n ]")
_TAIL = r"([a-zß-öø-ÿ0-9])([!),.:;?]+)([ \n]|$)"


def load_spec(path: str) -> str:
    """The tokenizer file as text, to be broadcast: executors need no copy of the file."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def pieces_of(chunk: str) -> list[str]:
    """The tokenizer's words of a chunk without white space."""
    chunk = _SIGNS.sub(r" \g<0> ", chunk)
    return (_DIGIT.sub(r" \g<0> ", chunk) if _DIGIT.search(chunk) else chunk).split()


class Encoder:
    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        shape = json.loads(spec)
        first = ((shape.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        suffix = shape["model"].get("end_of_word_suffix")
        pattern = str((first.get("pattern") or {}).get("Regex"))
        self.by_word = bool(suffix) and first.get("behavior") == "Removed" and first.get("invert") is True
        self.by_word &= pattern == "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
        # what comes after the cut changes no ASCII sign, letter or digit
        more = ((shape.get("pre_tokenizer") or {}).get("pretokenizers") or [])[1:]
        self.bare = all(p["type"] == "ByteLevel" and not p.get("add_prefix_space") and p.get("use_regex") is False for p in more)
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        if self.by_word:
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
            self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def _direct(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, np.uint32).tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _learn(self, new: list[str], known: dict[str, bytes]) -> None:
        """Encode new pieces: those of ASCII letters are words to the model as they are; the others go together, and each
        ends with its only token that has the suffix."""
        if self.bare:
            tokenize, rest = self.tokenizer.model.tokenize, []
            for piece in new:
                if piece.isascii():
                    known[piece] = np.array([t.id for t in tokenize(piece)], np.uint32).tobytes()
                else:
                    rest.append(piece)
            new = rest
        for a in range(0, len(new), 4000):
            part = new[a : a + 4000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.uint32)
            at = np.flatnonzero(self.ends[ids]) + 1
            if len(at) != len(part):
                known.update(zip(part, self._direct(part)))
                continue
            raw, start = ids.tobytes(), 0
            for piece, end in zip(part, (at * 4).tolist()):
                known[piece] = raw[start:end]
                start = end

    def _known(self, chunks: list[str]) -> list[bytes]:
        """Ids of distinct chunks. What was met since the last change of dictionaries stays, the rest of a full one goes."""
        if len(self.pieces) > MAX_PIECES // 2:
            self.pieces, self.older = {}, self.pieces
        known, older = self.pieces, self.older
        got = list(map(known.get, chunks))
        gaps = [k for k, ids in enumerate(got) if ids is None]
        new = []
        for k in gaps:
            if (ids := older.get(chunks[k])) is None:
                new.append(k)
            else:
                got[k] = known[chunks[k]] = ids
        if new:
            # a chunk of letters is a word by itself
            cut = [[c] if (c := chunks[k]).isalpha() else pieces_of(c) for k in new]
            own: dict[str, bytes] = {}
            words = []
            for p in {p for ps in cut for p in ps}:
                if (ids := known.get(p) or older.get(p)) is None:
                    words.append(p)
                else:
                    own[p] = ids
            self._learn(words, own)
            known.update(own)
            for k, ps in zip(new, cut):
                got[k] = own[ps[0]] if len(ps) == 1 else b"".join([own[p] for p in ps])
            known.update((chunks[k], got[k]) for k in new)
        return got

    def _lookup(self, texts: list[str]) -> list[bytes]:
        """Ids of plain texts: each distinct chunk is looked up once and its ids are gathered for all its places."""
        lower = pc.utf8_lower(pa.array(texts, pa.string()))
        # signs at the end of a word are words of their own: what is left recurs more often
        cut = pc.ascii_split_whitespace(pc.replace_substring_regex(lower, _TAIL, r"\1 \2\3"))
        chunks = cut.values.dictionary_encode()
        # by way of numpy, as a list of Arrow strings is made one by one
        rows = self._known(chunks.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids = pa.array(rows, pa.large_binary()).take(chunks.indices)
        _, ends, raw = ids.buffers()
        ends = np.frombuffer(ends, np.int64)[cut.offsets.to_numpy()].tolist()
        return [raw[a:b].to_pybytes() for a, b in zip(ends, ends[1:])]

    def _is_plain(self, text: str) -> bool:
        return _PLAIN.fullmatch(text) is not None and not any(s in text for s in self.special)

    def _odd(self, text: str) -> bytes:
        """A text with other characters: its plain words as ever, the others as they are."""
        words = text.replace("\n", " ").split(" ")
        plain = [self._is_plain(w) for w in words]
        ids = iter(self._lookup([w for w, p in zip(words, plain) if p]))
        out = []
        for word, p in zip(words, plain):
            if not p and word not in self.words:
                if len(self.words) >= MAX_WORDS:
                    self.words.clear()
                self.words[word] = self._direct([word])[0]
            out.append(next(ids) if p else self.words[word])
        return b"".join(out)

    def _together(self, texts: list[str]) -> list[bytes]:
        """Ids of plain texts, about ``TOGETHER`` characters at a time; a longer text is cut at white space."""
        out: list[bytes] = []
        held: list[str] = []
        room = TOGETHER
        for text in texts:
            if len(text) > TOGETHER:
                out += self._lookup(held)
                held, room, parts, a = [], TOGETHER, [], 0
                while a < len(text):
                    gap = _SPACE.search(text, a + TOGETHER)
                    b = gap.end() if gap else len(text)
                    parts += self._lookup([text[a:b]])
                    a = b
                out.append(b"".join(parts))
                continue
            held.append(text)
            room -= len(text)
            if room <= 0:
                out += self._lookup(held)
                held, room = [], TOGETHER
        return out + self._lookup(held)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; a null text has none."""
        if not self.by_word:
            return self._direct([t or "" for t in texts])
        whole = [t or "" for t in texts]
        plain = [self._is_plain(t) for t in whole]
        ids = iter(self._together([t for t, p in zip(whole, plain) if p]))
        return [next(ids) if p else self._odd(t) for t, p in zip(whole, plain)]


# Fixed value: the pattern by which byte-level tokenizers of rank files cut a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class RankEncoder:
    def __init__(self, spec: str):
        import tiktoken

        ranks = {base64.b64decode(token): int(rank) for token, rank in map(str.split, spec.splitlines())}
        self.tokenizer = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; a null text has none."""
        return [np.array(self.tokenizer.encode_ordinary(t or ""), np.uint32).tobytes() for t in texts]


@lru_cache(maxsize=2)
def encoder(spec: str) -> Encoder | RankEncoder:
    return Encoder(spec) if spec.lstrip().startswith("{") else RankEncoder(spec)
