"""Token ids of whole texts, by a public tokenizer file, one Arrow column at a time.

A word-wise vocabulary (lower case, white space dropped, letters and symbols
apart) never joins text across ASCII white space, nor across the place between
a letter or digit and the punctuation behind it: no match and no canonical
composition spans these. So a text's ids are those of its words, one after the
other, and A-Z may be lower-cased first. The words of a column are
dictionary-encoded, and only those that are new go through the tokenizer,
many as one text with a blank between them; words of a-z alone, which its rules
leave as they are, go through its vocabulary without them. A file that isn't
word-wise (``WORDWISE`` probes it) gets whole texts.

Memory: the column's words and ids (about 12 bytes per byte of text), plus the
words that the Python worker has met, at most ``KNOWN`` of ``LONGEST``
characters; beyond that the memory starts anew. A worker reads the file once.
"""

from __future__ import annotations

import functools
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

KNOWN = 500_000              # words remembered by a worker
LONGEST = 64                 # characters of a remembered word
AT_ONCE = 1 << 13            # characters of new words that are tokenised as one text
#: Letters of Latin script and digits, all of them ``\p{L}`` or ``\p{N}``, and the ASCII punctuation behind them that ends a word.
STOPS = r"([a-z0-9\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}])([!-/:-@\[-`{-~]+)([ \t\n\r\v\f]|$)"
#: Texts whose ids must be those of their words.
WORDWISE = ["Ab cD", "word, Word.\tI don't; it's 'sure'?", "a1b2: \n café! \x0bx", "end*** é### x'', 's.$$ don't% (a) a_ b-- c!"]


class WordEncoder:
    """``path``: a ``tokenizers`` file. Special tokens written out in a text
    are ordinary text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")     # a task has one core
        self.tokenizer = t = Tokenizer.from_file(path)
        t.encode_special_tokens = True
        self.bare = Tokenizer(t.model)                               # no rules but the blanks
        self.bare.pre_tokenizer = WhitespaceSplit()
        vocabulary = t.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True
        self._forget()
        self.wordwise = all(self._by_words(pa.array([x], pa.large_string()))[0].tolist() == self._plain([x])[0] for x in WORDWISE)
        self._forget()

    def _forget(self):
        self.places: dict[str, int] = {}                 # of a known word in first and size
        self.first, self.size, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _plain(self, texts: list[str], tokenizer=None) -> list[list[int]]:
        return [e.ids for e in (tokenizer or self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)]

    @staticmethod
    def _cuts(words: list[str]):
        """Ends of runs of words of about ``AT_ONCE`` characters."""
        ends = np.cumsum([len(w) + 1 for w in words])
        at = 0
        while at < len(words):
            stop = max(at + 1, int(np.searchsorted(ends, (int(ends[at - 1]) if at else 0) + AT_ONCE, "right")))
            yield at, stop
            at = stop

    def _of_letters(self, words: list[str], tokenizer=None):
        """``(ids, size)`` of words that are letters only, or None where some
        isn't one pre-token: each pre-token ends with the one id that ends a
        word, and a word has one at least."""
        ids = np.array([i for x in self._plain([" ".join(words[a:b]) for a, b in self._cuts(words)], tokenizer) for i in x], np.uint32)
        last = np.flatnonzero(self.ends[ids])
        return (ids, np.diff(last, prepend=-1)) if len(last) == len(words) and (not len(ids) or last[-1] == len(ids) - 1) else None

    def _of_ascii(self, words: list[str]):
        """The same for words of a-z alone."""
        return self._of_letters(words, self.bare)

    def _of_any(self, words: list[str]):
        """``(ids, size)``, told apart by their offsets."""
        parts, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for a, b in self._cuts(words):
            made = self.tokenizer.encode(" ".join(words[a:b]), add_special_tokens=False)
            ends = np.cumsum([len(w) + 1 for w in words[a:b]])
            where = np.searchsorted(ends, np.array([x[0] for x in made.offsets], np.int64), "right")
            parts.append(np.array(made.ids, np.uint32))
            sizes.append(np.bincount(where, minlength=b - a))
        return np.concatenate(parts), np.concatenate(sizes)

    def _lookup(self, words: list[str]):
        """Places of the words' ids in ``flat`` and their numbers."""
        if len(self.first) > KNOWN:
            self._forget()
        get = self.places.get
        places = [get(w, -1) for w in words]
        new = [i for i, p in enumerate(places) if p < 0]
        kinds: tuple[list[int], ...] = ([], [], [])
        for i in new:
            kinds[2 if not words[i].isalpha() else not words[i].isascii()].append(i)
        for own, how in zip(kinds, (self._of_ascii, self._of_letters, self._of_any), strict=True):
            if not own:
                continue
            fresh = [words[i] for i in own]
            ids, size = how(fresh) or self._of_any(fresh)
            base = len(self.first)
            self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(size) - size])
            self.size = np.concatenate([self.size, size])
            self.flat = np.concatenate([self.flat, ids])
            for k, i in enumerate(own):
                places[i] = base + k
                if len(words[i]) <= LONGEST:
                    self.places[words[i]] = base + k
        places = np.array(places, np.int64)
        return self.first[places], self.size[places], self.flat

    def _by_words(self, texts):
        lower = pc.replace_substring_regex(pc.ascii_lower(texts), STOPS, r"\1 \2\3")
        lists = pc.ascii_split_whitespace(lower)
        words = lists.flatten().dictionary_encode()
        parent = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        first, size, flat = self._lookup(words.dictionary.to_pylist())
        code = words.indices.to_numpy(zero_copy_only=False)
        n = size[code]
        ends = np.concatenate([[0], np.cumsum(n)])
        ids = flat[np.arange(ends[-1]) + np.repeat(first[code] - ends[:-1], n)]
        return ids, ends[np.concatenate([[0], np.cumsum(parent)])]

    def __call__(self, column) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, bounds)``: text i has ``ids[bounds[i]:bounds[i + 1]]``; null
        counts as empty."""
        texts = column.fill_null("").cast(pa.large_string())
        if self.wordwise:
            return self._by_words(texts)
        per = self._plain(texts.to_pylist())
        return np.array([i for x in per for i in x], np.uint32), np.concatenate([[0], np.cumsum([len(x) for x in per])]).astype(np.int64)


@functools.lru_cache(maxsize=1)
def word_encoder(path: str) -> WordEncoder:
    """The worker's encoder of a file, with the words it has met."""
    return WordEncoder(path)
