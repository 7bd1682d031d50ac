"""Byte pair merges of many words at once, from a vocabulary's own definition.

A word begins as its bytes, the last one marked as the end of a word.  Again
and again the pair of neighbours that comes first in the list of merges becomes
one token, the leftmost of equal ones first, until no pair is in the list.
Words of one length that have had the same number of merges have the same
number of symbols, so they are rows of one matrix.
"""

from __future__ import annotations

import json

import numpy as np

NONE = np.int32(1 << 30)

#: What a vocabulary file does before its merges, if runs of letters are to be merged alone.
NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
PIECES = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it can be seen, else the next one after 255."""
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    unseen = [byte for byte in range(256) if byte not in seen]
    return [chr(byte) if byte in seen else chr(256 + unseen.index(byte)) for byte in range(256)]


def merges_letters_alone(definition: dict) -> bool:
    """Whether, by this definition, a run of letters between blanks or punctuation is one piece for the merges.

    Then its ids depend on its lower-case letters alone: composed letters are
    normal already, blanks only part pieces, and no other step looks at them.
    """
    split, letters = [*(definition.get("pre_tokenizer") or {}).get("pretokenizers", []), {}, {}][:2]
    model = definition["model"]
    return (
        (definition.get("normalizer") or {}).get("normalizers") == NORMALIZER
        and split.get("type") == "Split"
        and split.get("pattern") == {"Regex": PIECES}
        and letters.get("type") == "ByteLevel"
        and not letters.get("add_prefix_space")
        and not letters.get("use_regex")
        and model.get("type") == "BPE"
        and not any(model.get(name) for name in ("dropout", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges"))
        and len(model["vocab"]) + len(definition.get("added_tokens", [])) < 1 << 16
    )


class Merges:
    """The merges of a vocabulary whose ids are below 65,536."""

    def __init__(self, model: dict):
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        letters = byte_letters()
        self.inside = np.array([vocab[letter] for letter in letters], np.int32)
        self.ending = np.array([vocab[letter + suffix] for letter in letters], np.int32)
        pairs = [pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"]]
        keys = np.array([(vocab[a] << 16) | vocab[b] for a, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        # ranks of the pairs that words begin with, by their bytes
        first, second = np.divmod(np.arange(1 << 16), 256)
        self.start = self.rank(self.inside[first], self.inside[second])
        self.start_last = self.rank(self.inside[first], self.ending[second])

    @classmethod
    def of_file(cls, path: str) -> Merges | None:
        """The merges of a vocabulary file, if its definition allows to use them alone."""
        with open(path, encoding="utf-8") as file:
            definition = json.load(file)
        return cls(definition["model"]) if merges_letters_alone(definition) else None

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(np.int64) << 16) | right
        at = np.searchsorted(self.keys, key).clip(max=len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, little-endian unsigned 32-bit."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ids = [b""] * len(words)
        for size in np.unique(sizes[sizes > 0]).tolist():
            which = np.flatnonzero(sizes == size)
            data = np.frombuffer(b"".join([words[k] for k in which.tolist()]), np.uint8).reshape(-1, size)
            symbols = self.inside[data]
            symbols[:, -1] = self.ending[data[:, -1]]
            pairs = (data[:, :-1].astype(np.int32) << 8) | data[:, 1:]
            ranks = self.start[pairs]
            ranks[:, -1:] = self.start_last[pairs[:, -1:]]
            for rows, found in self.merged(symbols, ranks):
                blob, width = found.astype("<u4").tobytes(), 4 * found.shape[1]
                for n, k in enumerate(which[rows].tolist()):
                    ids[k] = blob[n * width : (n + 1) * width]
        return ids

    def merged(self, symbols: np.ndarray, ranks: np.ndarray):
        """(rows, their final symbols), by the number of symbols that are left; ``ranks`` are those of all pairs."""
        rows = np.arange(len(symbols))
        while symbols.shape[1] > 1:
            here = np.arange(len(rows))
            at = ranks.argmin(1)
            best = ranks[here, at]
            ready = best == NONE
            if ready.any():
                yield rows[ready], symbols[ready]
                rows, symbols, ranks, at, best = rows[~ready], symbols[~ready], ranks[~ready], at[~ready], best[~ready]
                here = np.arange(len(rows))
            if not len(rows):
                return
            # the symbol after the pair's first goes; pairs on both sides of the new symbol are looked up
            width = symbols.shape[1]
            kept = np.arange(width - 1)[None, :]
            symbols = np.take_along_axis(symbols, kept + (kept > at[:, None]), 1)
            symbols[here, at] = self.made[best]
            if width > 2:
                pair = kept[:, :-1]
                ranks = np.take_along_axis(ranks, pair + (pair >= at[:, None]), 1)
                before = np.flatnonzero(at > 0)
                ranks[before, at[before] - 1] = self.rank(symbols[before, at[before] - 1], symbols[before, at[before]])
                after = np.flatnonzero(at < width - 2)
                ranks[after, at[after]] = self.rank(symbols[after, at[after]], symbols[after, at[after] + 1])
        yield rows, symbols
