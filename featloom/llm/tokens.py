"""Token ids of whole texts with a public byte-level vocabulary."""

from __future__ import annotations

import json
import os
import re
from functools import cached_property, lru_cache

import numpy as np

_NEIGHBOURS = re.compile(r"\s\s")
#: Spark runs one task on each core; a thread pool of the tokenizers library in each Python worker only adds CPU.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids as ``tokenizers`` gives them for the vocabulary file, without special tokens added.

    The merges of the file are run by ``tiktoken`` (the same byte-level scheme, several times faster);
    texts that hold a special token's string go to ``tokenizers`` itself. The rule for runs of white space
    needs look-ahead, so texts without such runs take a pattern without it.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        special = {t["content"] for t in file["added_tokens"]}
        self.special = re.compile("|".join(map(re.escape, sorted(special))) or r"(?!)")
        ranks = _ranks(file["model"]["vocab"], special)
        pattern = public_tokenizers.PATTERN
        self.runs = tiktoken.Encoding("runs", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.plain = tiktoken.Encoding("plain", pat_str=pattern.replace(r"\s+(?!\S)|", ""), mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def full(self):
        """The tokenizer of the file itself; most workers never meet a text that needs it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def ids(self, text: str) -> np.ndarray:
        if self.special.search(text):
            return np.array(self.full.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.plain_ids(text)

    def plain_ids(self, text: str) -> np.ndarray:
        """Ids of a text in which special tokens' strings are ordinary text."""
        coder = self.runs if _NEIGHBOURS.search(text) else self.plain
        return np.array(coder.encode_ordinary(text), np.uint32)


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary file stands for."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(other)}


def _ranks(ids: dict[str, int], special: set[str]) -> dict[bytes, int]:
    """Byte strings of the vocabulary. The file writes each byte as a printable character: bytes with
    a printable Latin-1 character as that, the others in order from U+0100."""
    byte_of = _byte_of()
    return {bytes(byte_of[c] for c in token): i for token, i in ids.items() if token not in special}


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each worker process and file."""
    return Encoder(path)


class Remembered:
    """Values by key in ``new``, of which about the ``most`` used last are kept: when it is half full, its values become the older half,
    from which they come back when they are asked for (``recall``)."""

    def __init__(self, most: int):
        self.most, self.new, self.older = most, {}, {}

    def tidy(self) -> None:
        """Makes room; to be called before ``new`` is looked into."""
        if len(self.new) > self.most // 2:
            self.new, self.older = {}, self.new

    def recall(self, keys: set) -> list:
        """The unknown ones of keys that are not in ``new``; the known ones are in it afterwards."""
        unknown = []
        for k in keys:
            if (value := self.older.get(k)) is None:
                unknown.append(k)
            else:
                self.new[k] = value
        return unknown


class WordEncoder:
    """Ids as ``tokenizers`` gives them for a vocabulary whose tokens never hold or cross white space.

    A text is cut at ASCII blanks; each piece is encoded by ``tokenizers``, short pieces once (about
    ``PIECES`` are remembered), so the ids are those of the whole text. Of a word of Latin letters with closing marks behind it
    the word is encoded in lower case and by the model alone, which spares the search for patterns; such words stand behind each other in
    one call and end where a token with the mark of a word's end stands. ``width`` is the bytes of an id.
    """

    PIECES = 500_000
    SHORT = 48
    #: Letters whose composition and lower case are one character each.
    LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0132-\u017e]+")
    CLOSING = b".,;:!?"
    WORD_END = "</w>"

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.full, self.model = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.model.normalizer, self.model.pre_tokenizer = normalizers.Sequence([]), pre_tokenizers.WhitespaceSplit()
        vocabulary = self.full.get_vocab()
        self.width = 2 if max(vocabulary.values()) < 1 << 16 else 4
        self.kind = np.dtype(f"<u{self.width}")
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith(self.WORD_END)]] = True
        self.shown = str.maketrans({chr(b): c for c, b in _byte_of().items()})
        self.known = Remembered(self.PIECES)

    def _encode(self, pieces: list[bytes]) -> list[bytes]:
        found = self.full.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)
        return [np.array(e.ids, self.kind).tobytes() for e in found]

    def _encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of small letters."""
        shown = [w.decode("latin-1").translate(self.shown) for w in words]
        joined = [" ".join(shown[i : i + 500]) for i in range(0, len(words), 500)]
        found = self.model.encode_batch_fast(joined, add_special_tokens=False)
        ids = np.concatenate([np.zeros(0, self.kind), *(np.array(e.ids, self.kind) for e in found)])
        raw, last = ids.tobytes(), (np.flatnonzero(self.ends_word[ids]) + 1) * self.width
        return [raw[a:b] for a, b in zip([0, *last[:-1].tolist()], last.tolist())]

    def _learn(self, missing: list[bytes]) -> dict[bytes, bytes]:
        parts, words, rest = {}, {}, {}
        for p in missing:
            core = p.rstrip(self.CLOSING)
            text = core.decode()
            if self.LETTERS.fullmatch(text):
                word, tail = text.lower().encode(), p[len(core) :]
                parts[p] = word, tail
                words[word] = None
                if tail:
                    rest[tail] = None
            else:
                rest[p] = None
        new, older = self.known.new, self.known.older
        here = {p: i for p in (*words, *rest) if (i := new.get(p) or older.get(p)) is not None}
        words, rest = ([p for p in pieces if p not in here] for pieces in (words, rest))
        here |= dict(zip(words, self._encode_words(words))) | dict(zip(rest, self._encode(rest)))
        return here | {p: here[word] + here[tail] if tail else here[word] for p, (word, tail) in parts.items()}

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text, ``width`` bytes little-endian each."""
        cut = [t.split() for t in texts]
        self.known.tidy()
        known = self.known.new
        unknown = self.known.recall({p for pieces in cut for p in pieces if p not in known})
        here = self._learn(unknown)
        long = {p: i for p, i in here.items() if len(p) > self.SHORT}
        known.update((p, i) for p, i in here.items() if p not in long)
        if long:
            return [b"".join([long[p] if p in long else known[p] for p in pieces]) for pieces in cut]
        return [b"".join([known[p] for p in pieces]) for pieces in cut]


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)
