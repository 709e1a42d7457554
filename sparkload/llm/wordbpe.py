"""A byte-pair vocabulary whose words end in a marked symbol: ids of whole texts, and of any cut of their symbols.

A text is written as a *stream*: its words in the vocabulary's byte alphabet, each followed by a space that
belongs to the word's last symbol. No merge crosses such an end, so byte-pair encoding of a text is that of its
stream, wherever the tokenizer parts words. A stream can be cut behind any symbol.
"""

from __future__ import annotations

import json
import os
import re
import string
from array import array
from collections.abc import Iterator
from functools import cached_property

import numpy as np

TEXT_CHARS = 1 << 20  # texts encoded at once
CACHE_BYTES = 48 << 20  # of what is remembered, in each of two generations
CACHED_CHUNK = 64  # characters; longer chunks are not remembered
ENTRY_BYTES = 200  # a key, its ids and their places in a table, besides their contents
_ASKED_AT_ONCE = 512
_CLOSING = "".join(c for c in string.punctuation if c != "'")  # an apostrophe may begin a word

# A comma or full stop before a space is a word of its own for the tokenizer if it follows one of these; a text
# where it follows anything else is cut at spaces alone.
_STRANGE_CLOSE = re.compile(r"[,.] (?<=[^A-Za-zÀ-ÖØ-öø-ÿ0-9][,.] )")


def chunks_of(text: str) -> list[str]:
    """A text cut at spaces and newlines, and before the commas and full stops that end most chunks."""
    text = text.replace("\n", " ")
    if not _STRANGE_CLOSE.search(text):
        text = text.replace(", ", " , ").replace(". ", " . ")
    return text.split(" ")


class WordVocabulary:
    """The tokenizer of a file, and its merges alone for words and for cuts of words."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, models, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model.get("end_of_word_suffix")
        if model["type"] != "BPE" or not self.end:
            raise ValueError(f"{path} is not a byte-pair vocabulary with marked word ends")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._at_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]

        def merger(**suffix: str):
            made = Tokenizer(models.BPE(vocab=model["vocab"], merges=merges, **suffix))
            made.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
            return made

        self._whole = merger(end_of_word_suffix=self.end)
        self._make_open = merger
        n = 1 + max([*model["vocab"].values(), *self.special.values()])
        self.token = [""] * n  # how decoding writes an id
        self.symbols = [""] * n  # the part of a stream that an id stands for
        for token, i in model["vocab"].items():
            self.token[i] = token
            self.symbols[i] = token.removesuffix(self.end) + " " if token.endswith(self.end) else token
        self._mark = {}  # special tokens are single symbols that no merge knows
        for k, (token, i) in enumerate(self.special.items()):
            self.token[i], self._mark[token] = token, chr(0xE000 + k)
            self.symbols[i] = self._mark[token] + " "
        self._id_of_mark = {m: self.special[t] for t, m in self._mark.items()}
        self._marks = re.compile("([" + "".join(self._id_of_mark) + "] )") if self._id_of_mark else None

    def ask(self, chunks: list[str]) -> list[list[int]]:
        """Ids of chunks by the tokenizer itself."""
        out: list[list[int]] = []
        for k in range(0, len(chunks), _ASKED_AT_ONCE):
            found = self.tokenizer.encode_batch_fast(chunks[k : k + _ASKED_AT_ONCE], add_special_tokens=False)
            out += [f.ids for f in found]
        return out

    def ask_words(self, words: list[str], ascii_only: bool) -> list[list[int]]:
        """Ids of words of letters, ``_ASKED_AT_ONCE`` together; the only normal form of ASCII letters is lower case."""
        groups = [" ".join(words[k : k + _ASKED_AT_ONCE]) for k in range(0, len(words), _ASKED_AT_ONCE)]
        if ascii_only:
            found = self._whole.encode_batch_fast([g.lower() for g in groups], add_special_tokens=False)
        else:
            found = self.tokenizer.encode_batch_fast(groups, add_special_tokens=False)
        return [f.ids for f in found]

    def stream(self, chunk: str) -> str:
        """A text, or a chunk of it between spaces, as a stream."""
        out = []
        for k, part in enumerate(self._at_special.split(chunk) if self._at_special else [chunk]):
            if k % 2:
                out.append(self._mark[part] + " ")
            elif part:
                words = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(part))
                out += [word + " " for word, _ in words]
        return "".join(out)

    def merge(self, stream: str) -> list[int]:
        """Ids of a stream, or of a cut of one: its last word may lack its end, its first its beginning."""
        if self._marks and (parts := self._marks.split(stream))[1:]:
            ids: list[int] = []
            for k, part in enumerate(parts):
                ids += [self._id_of_mark[part[0]]] if k % 2 else self._merge(part)
            return ids
        return self._merge(stream)

    @cached_property
    def _open(self):
        """Merges of symbols of which the last does not end a word."""
        return self._make_open()

    def _merge(self, stream: str) -> list[int]:
        whole, space, rest = stream.rpartition(" ")
        ids = self._whole.encode(whole, add_special_tokens=False).ids if space else []
        return ids + self._open.encode(rest, add_special_tokens=False).ids if rest else ids


class ChunkEncoder:
    """Token ids of texts from the vocabulary, which is asked once for each new chunk between spaces.

    Exact for a tokenizer whose tokens never span white space and that drops it; its normaliser and its split
    pattern then work within a chunk. Chunks up to ``CACHED_CHUNK`` characters are remembered in two generations
    of ``CACHE_BYTES``; longer ones only while the texts at hand are encoded.
    """

    def __init__(self, path: str):
        self.vocabulary = WordVocabulary(path)
        ends = [t.endswith(self.vocabulary.end) for t in self.vocabulary.token]
        self.ends_word = np.array(ends, bool)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.size = 0

    def _learn(self, chunks: set[str]) -> list[str]:
        """Make all the chunks known; returns those that are not to be remembered."""
        known, older = self.known, self.older
        if older and (again := chunks & older.keys()):
            known |= {c: older[c] for c in again}
            self.size += len(again) * (ENTRY_BYTES + 20)
            chunks = chunks - again
        made = []  # letters and the marks behind them are words of their own
        for chunk in [c for c in chunks if not c.isalpha()]:
            letters = chunk.rstrip(_CLOSING)
            if len(letters) < len(chunk) and letters.isalpha() and letters.lower().isalpha():
                made.append((chunk, letters, chunk[len(letters) :]))
        if made:
            whole, letters, closing = zip(*made)
            chunks = (chunks.difference(whole) | set(letters).union(closing)).difference(known)
        letters = {c for c in chunks if c.isalpha()}
        plain = [c for c in letters if c.isascii()]
        accented = [c for c in letters.difference(plain) if c.lower().isalpha()]
        others = list(chunks.difference(plain, accented))
        for words in (plain, accented):
            for k, ids in enumerate(self.vocabulary.ask_words(words, words is plain)):
                group = words[k * _ASKED_AT_ONCE : (k + 1) * _ASKED_AT_ONCE]
                found = np.array(ids, "<u4")
                ends = (4 * (np.flatnonzero(self.ends_word[found]) + 1)).tolist()
                if len(ends) != len(group):  # the tokenizer sees other letters than Python does
                    others += group
                    continue
                data = found.tobytes()
                known.update(zip(group, [data[i:j] for i, j in zip([0, *ends], ends)]))
        known.update(zip(others, [array("I", ids).tobytes() for ids in self.vocabulary.ask(others)]))
        known.update([(chunk, known[a] + known[b]) for chunk, a, b in made])
        long = [c for c in (*others, *[m[0] for m in made]) if len(c) > CACHED_CHUNK]
        self.size += (len(chunks) + len(made) - len(long)) * ENTRY_BYTES + 3 * sum(map(len, letters))
        return long

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        at = 0
        while at < len(texts):
            size, group = 0, []
            while at < len(texts) and (not group or size + len(texts[at]) <= TEXT_CHARS):
                group.append(chunks_of(texts[at]))
                size += len(texts[at])
                at += 1
            if self.size > CACHE_BYTES:
                self.older, self.known, self.size = self.known, {}, 0
            known = self.known
            new = set().union(*group).difference(known)
            passing = self._learn(new) if new else ()
            get = known.__getitem__
            for parts in group:
                yield b"".join(map(get, parts))
            for chunk in passing:
                del known[chunk]
