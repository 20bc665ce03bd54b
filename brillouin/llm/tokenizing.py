"""Token ids of a public tokenizer file, word by word.

The word BPE drops white space and never merges across it, so a text's ids are the ids of its words in turn, and a
task looks words up in a bounded cache.  New words of plain Latin letters, digits and ASCII marks go
through a byte-pair encoder over the same merge list (an end-of-word byte stands for the word end); every other
word, and every tokenizer file of another kind, goes through the tokenizer itself.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np

#: Words that a Python worker keeps; the cache is emptied when it is full.
CACHE_WORDS = 400_000

# How the word BPE splits a text, and the bytes that byte-level BPE files write as themselves.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_AS_THEMSELVES = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

_PLAIN = re.compile(rb"(?:[!-~]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
_PARTS = re.compile(r"('s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ\n]+)")


class WordIds:
    """Ids of words (bytes without ASCII white space), as little-endian 32-bit bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.cache: dict[bytes, bytes] = {}
        self.by_word = self._splits_words(spec)
        self.closing = self._closing(spec)
        if self.by_word:
            self._byte_pairs(spec)

    @staticmethod
    def _splits_words(spec: dict) -> bool:
        """Is this the kind of file that the plain path knows?"""
        steps = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        split = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        model = spec.get("model", {})
        return steps == ["NFC", "Replace", "Lowercase"] and split.get("pattern") == {"Regex": _SPLIT} and model.get("type") == "BPE" and model.get("end_of_word_suffix") == "</w>" and not model.get("continuing_subword_prefix")

    @staticmethod
    def _closing(spec: dict) -> np.ndarray:
        """For each id: does the token end a sentence?"""
        vocab = spec["model"].get("vocab", {})
        out = np.zeros(max(vocab.values(), default=0) + 2, bool)
        for token, i in vocab.items():
            out[i] = token.removesuffix("</w>").rstrip("\"')").endswith((".", "!", "?"))
        return out

    def _byte_pairs(self, spec: dict) -> None:
        import tiktoken

        byte = {chr(b): b for b in _AS_THEMSELVES}
        byte |= {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(_AS_THEMSELVES)))}

        def raw(token: str) -> bytes:
            body = token.removesuffix("</w>")
            return bytes(byte[c] for c in body) + b"\0" * (body != token)

        order = [bytes([b]) for b in range(256)] + [bytes([b, 0]) for b in range(256)]
        order += [raw(a) + raw(b) for a, b in (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])]
        ranks = {piece: k for k, piece in enumerate(dict.fromkeys(order))}
        ids = {raw(t): i for t, i in spec["model"]["vocab"].items() if not t.startswith("<|")}
        self.encoder = tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={})
        self.id_of = np.array([ids.get(p, 0) for p in ranks], np.uint32)
        self.ends_word = np.array([p.endswith(b"\0") for p in ranks])

    def _learn(self, words: list[bytes]) -> None:
        plain = [w for w in words if _PLAIN.fullmatch(w) and b"<|" not in w]
        if plain:
            parts = _PARTS.sub("\\1\x00", b"\n".join(plain).decode().lower())
            raw = np.frombuffer((parts + "\n").encode(), np.uint8)
            n_parts = np.cumsum(raw == 0)[raw == 10]
            got = np.array(self.encoder.encode_ordinary(parts.replace("\n", "")))
            ends = np.flatnonzero(self.ends_word[got]) + 1
            ends = (4 * ends[n_parts - 1]).tolist()
            data, at = self.id_of[got].astype("<u4").tobytes(), 0
            for word, to in zip(plain, ends, strict=True):
                self.cache[word] = data[at:to]
                at = to
        known = set(plain)
        other = [w for w in words if w not in known]
        if other:
            for word, out in zip(other, self.tokenizer.encode_batch([w.decode("utf-8", "replace") for w in other], add_special_tokens=False), strict=True):
                self.cache[word] = np.array(out.ids, "<u4").tobytes()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text."""
        if not self.by_word:
            got = self.tokenizer.encode_batch([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
            return [np.array(x.ids, "<u4").tobytes() for x in got]
        words = [t.split() for t in texts]
        new = set().union(*words).difference(self.cache)
        if new:
            if len(self.cache) + len(new) > CACHE_WORDS:
                self.cache.clear()
                new = set().union(*words)
            self._learn(list(new))
        get = self.cache.__getitem__
        return [b"".join(map(get, w)) for w in words]


@lru_cache(1)
def word_ids(path: str) -> WordIds:
    """One for each Python worker and file."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return WordIds(path)
