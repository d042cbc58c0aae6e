"""Token ids of whole texts, with a bounded memory of the words seen before."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np

#: Different words that are remembered before the memory starts anew.
REMEMBERED = 1_200_000
#: Characters whose words are looked up together.
STRETCH = 4_000_000
#: Words that go to the tokenizer as one text.
JOINED = 64
#: Signs that end many words, and where they touch other signs.
CLOSING = ",."
UNSAFE = re.compile(r"[,.](?<=[\W_][,.])(?=[ \n])")
BLANK_LINES = re.compile(r"\n+")
#: Put before what has ids of its own whatever it follows, and before the first word of a line.
MARK, HEAD = "\x01", "\x02"


class WordwiseEncoder:
    """Ids as little-endian unsigned 32-bit integers, equal to those of the whole text.

    The text is cut at single spaces and line ends, and before a comma or full stop that follows a
    letter or digit and ends a word. A byte-level tokenizer that keeps the space with the word
    after it (``keeps_space``) never joins ids across such a place, provided neither side is
    white space too; texts that break this go to the tokenizer whole. A tokenizer that drops
    white space never joins ids across any of it."""

    def __init__(self, path: str, keeps_space: bool):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.model._resize_cache(0)  # words are remembered here
        self.keeps_space = keeps_space
        self.forget()

    def forget(self) -> None:
        """A number for each word, the place of its ids in a pool, how many they are (-1: it can't
        stand alone)."""
        self.number: dict[str, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.pool, self.used, self.known = np.zeros(1 << 20, "<u4"), 0, 0
        self.start, self.size = np.zeros(1 << 18, np.int64), np.zeros(1 << 18, np.int32)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        stretch: list[str] = []
        size = 0
        for text in texts:
            stretch.append(text)
            size += len(text)
            if size >= STRETCH:
                yield from self._stretch(stretch)
                stretch, size = [], 0
        yield from self._stretch(stretch)

    def words(self, text: str) -> list[str]:
        """The pieces of a text; a piece that can't stand alone if the text can't be cut."""
        if MARK in text or HEAD in text:
            return [HEAD]
        if text[:1] not in CLOSING and not UNSAFE.search(text):
            for mark in CLOSING:
                text = text.replace(mark + " ", f" {MARK}{mark} ").replace(mark + "\n", f" {MARK}{mark}\n")
        if self.keeps_space:
            if "\n\n" in text:
                text = BLANK_LINES.sub(lambda m: f" {MARK}{m[0]} {HEAD}", text)
            else:
                text = text.replace("\n", f" {MARK}\n {HEAD}")
            return (HEAD + text).split(" ") if text else []
        return text.replace("\n", " ").split(" ")

    def _stretch(self, texts: list[str]) -> Iterator[bytes]:
        if len(self.number) > REMEMBERED:
            self.forget()
        find = self.number.__getitem__
        places = [np.fromiter(map(find, words), np.int64, len(words)) for words in map(self.words, texts)]
        self._learn(list(islice(self.number, self.known, None)))
        for text, place in zip(texts, places):
            sizes = self.size[place]
            if len(place) and sizes.min() < 0:
                yield self.whole(text)
                continue
            ends = np.cumsum(sizes)
            at = np.repeat(self.start[place] - ends + sizes, sizes)
            at += np.arange(len(at))
            yield self.pool[at].tobytes()

    def _learn(self, new: list[str]) -> None:
        """Ids of the words that have a number and nothing else yet."""
        first, last = self.known, self.known + len(new)
        self.known = last
        while last > len(self.start):
            self.start, self.size = np.concatenate([self.start] * 2), np.concatenate([self.size] * 2)
        self.size[first:last] = -1
        plain, heads = [], []
        for number, word in enumerate(new, first):
            if word[:1] == MARK:
                # of several line ends before a word the last one stands apart
                own = self.whole(word[1:]) if word[1:2] != "\n" or len(word) == 2 else self.whole(word[2:]) + self.whole("\n")
                self._keep(np.array([number]), np.frombuffer(own, "<u4"), np.array([0]), np.array([1 << 30]))
            elif word[:1] == HEAD:
                if word[1:] and word[1:].strip() == word[1:]:
                    heads.append((number, word[1:]))
            elif word and word.strip() == word:
                plain.append((number, word))
            elif not self.keeps_space:
                self._keep(np.array([number]), np.frombuffer(self.whole(word), "<u4"), np.array([0]), np.array([1 << 30]))
        self._look_up(plain, " ", " ")
        self._look_up(heads, "\n", "")

    def _look_up(self, words: list[tuple[int, str]], sign: str, lead: str) -> None:
        words.sort(key=lambda w: len(w[1]))
        groups = [words[i : i + JOINED] for i in range(0, len(words), JOINED)]
        for some in (groups[i : i + 256] for i in range(0, len(groups), 256)):
            joined = [lead + sign.join([word for _, word in group]) for group in some]
            for group, found in zip(some, self.tokenizer.encode_batch(joined, add_special_tokens=False)):
                begins = np.array([span[0] for span in found.offsets], np.int64)
                edges = np.cumsum([0] + [len(word) + 1 for _, word in group])
                # without a lead the sign comes before the next word and has ids of its own
                a, b = np.searchsorted(begins, edges[:-1]), np.searchsorted(begins, edges[1:] - (not lead))
                self._keep(np.array([number for number, _ in group]), np.array(found.ids, "<u4"), a, b)

    def _keep(self, numbers: np.ndarray, ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool] * 2)
        self.pool[self.used : self.used + len(ids)] = ids
        self.start[numbers], self.size[numbers] = self.used + a, np.minimum(b, len(ids)) - a
        self.used += len(ids)


@lru_cache(maxsize=2)
def encoder(path: str, keeps_space: bool) -> WordwiseEncoder:
    """The encoder of this worker process, kept from task to task."""
    return WordwiseEncoder(path, keeps_space)
