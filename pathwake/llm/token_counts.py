"""Token counts by a tokenizer compiled to finite-state transducers.

Two machines are compiled from the vocabulary file of a word-end BPE tokenizer.

*Splitting.* A transducer over classes of characters marks where pre-tokens start, if need be one
character late (``'r`` may become ``'re``). Its transitions generate a finite set of state maps,
so a chunk of text is one map, whatever state it starts in. Chunks are read side by side, their
maps are composed by a parallel prefix scan, and with the starting states known the chunks are
read again to emit the marks.

*Words.* The state after a prefix of a word is, for every suffix that can still grow to a token,
its place in the trie of tokens and the last token of the prefix before it. Exactly one token
that ends a prefix agrees with the last token before it; two tokens agree if undoing their
merges, the latest first, never shows a pair across the border that would have been merged
earlier. A transition adds the count before that token plus one; the transition that ends a
word uses the tokens with the word-end mark. All new words of a slice step together.

A transition looks back no further than the longest token, so two runs that agree on so many
prefixes in a row, and differ by one number in all their counts, go on alike. A long word is read
in chunks side by side, each from some way before its start as if a word began there. Where
neighbours agree up to the border, a chunk's map takes every state before it to the same state
and adds to the count what the border shows; the sums over the borders compose the maps.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathwake.llm.arrays import U64, _radix_powers, mix

LIMIT = 2048
SLICE_CHARS = 1 << 20
CHUNK = 512
# Distinct words whose counts a Python worker remembers; beyond this it forgets all and goes on.
REMEMBERED = 1_000_000
# Ways before a chunk of a long word, tried in order: multiples of many small numbers, so that
# words that repeat a piece fall into step too. A word that never does is read in one go.
OVERLAPS = (1680, 6720, 26880)

# Classes of characters. S, R, V, L, E are letters that contractions are made of.
SPACE, LETTER, NUMBER, SIGN, QUOTE, S, R, V, L, E = range(10)
_WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# States: between tokens, in letters, after a number, in signs, after a quote that starts a
# token, after such a quote and r, v or l, after a contraction.
GAP, LETTERS, NUMBERS, SIGNS, QUOTED, QUOTED_R, QUOTED_V, QUOTED_L, CONTRACTED = range(9)
HERE, BEFORE = 1, 2  # marks: a token starts at this character, or at the one before


def splitter() -> tuple[np.ndarray, np.ndarray]:
    """``next[state, class]`` and ``marks[state, class]`` of the splitting transducer."""
    following, marks = np.zeros((9, 10), np.int64), np.zeros((9, 10), np.int64)
    fresh = {NUMBER: NUMBERS, SIGN: SIGNS, QUOTE: QUOTED} | dict.fromkeys((LETTER, S, R, V, L, E), LETTERS)
    for state in range(9):
        for c, target in fresh.items():
            following[state, c], marks[state, c] = target, HERE
    for c in (LETTER, S, R, V, L, E):
        marks[LETTERS, c] = 0
    for state in (SIGNS, QUOTED):
        for c in (SIGN, QUOTE):
            following[state, c], marks[state, c] = SIGNS, 0
    for c, target in ((S, CONTRACTED), (R, QUOTED_R), (V, QUOTED_V), (L, QUOTED_L)):
        following[QUOTED, c], marks[QUOTED, c] = target, 0
    for state, ending in ((QUOTED_R, E), (QUOTED_V, E), (QUOTED_L, L)):
        following[state], marks[state] = following[LETTERS], marks[LETTERS] | BEFORE
        following[state, ending], marks[state, ending] = CONTRACTED, 0
    return following, marks


def state_maps(following: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All maps of states that texts can cause, and ``then[map, class]``, the map one character on."""
    identity = tuple(range(len(following)))
    numbers, rows, at = {identity: 0}, [], 0
    known = [identity]
    while at < len(known):
        row = []
        for c in range(following.shape[1]):
            image = tuple(int(following[s, c]) for s in known[at])
            if image not in numbers:
                numbers[image] = len(known)
                known.append(image)
            row.append(numbers[image])
        rows.append(row)
        at += 1
    return np.array(known), np.array(rows)


class Splitter:
    def __init__(self):
        self.following, self.marks = splitter()
        self.maps, self.then = state_maps(self.following)
        kinds = np.full(0x110000, SIGN, dtype=np.uint8)
        for code in range(0x110000):
            category = unicodedata.category(chr(code))[0]
            if category == "L":
                kinds[code] = LETTER
            elif category == "N":
                kinds[code] = NUMBER
        kinds[_WHITE] = SPACE
        for chars, kind in (("'", QUOTE), ("stmd", S), ("r", R), ("v", V), ("l", L), ("e", E)):
            kinds[[ord(c) for c in chars]] = kind
        self.kinds = kinds

    def tokens(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the pre-tokens; the last code has to be white space."""
        kinds = self.kinds[codes]
        lanes = -(-len(kinds) // CHUNK)
        padded = np.zeros(lanes * CHUNK, dtype=np.int64)  # white space at the end
        padded[:len(kinds)] = kinds
        steps = np.ascontiguousarray(padded.reshape(lanes, CHUNK).T)
        maps = np.zeros(lanes, dtype=np.int64)
        for step in steps:
            maps = self.then[maps, step]
        # Inclusive scan: after it row i is the map of all chunks up to i.
        scan = self.maps[maps]
        reach = 1
        while reach < lanes:
            scan[reach:] = np.take_along_axis(scan[reach:], scan[:-reach].copy(), axis=1)
            reach *= 2
        states = np.concatenate([[GAP], scan[:-1, GAP]])
        emitted = np.empty_like(steps)
        for k, step in enumerate(steps):
            emitted[k] = self.marks[states, step]
            states = self.following[states, step]
        emitted = emitted.T.ravel()[:len(kinds)]
        starts = (emitted & HERE) > 0
        starts[:-1] |= (emitted[1:] & BEFORE) > 0
        edges = np.flatnonzero(starts | (kinds == SPACE))
        opens = np.flatnonzero(starts[edges])
        return edges[opens], edges[opens + 1]


class WordCounter:
    """Counts the tokens of words, given as UTF-8 bytes."""

    def __init__(self, model: dict):
        if model["type"] != "BPE" or not model.get("end_of_word_suffix") or model.get("unk_token"):
            raise ValueError("a BPE vocabulary with word ends and without an unknown token is needed")
        suffix = model["end_of_word_suffix"]
        vocabulary: dict[str, int] = model["vocab"]
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        self.size = size = max(vocabulary.values()) + 1
        self.rank = np.full(size, -1, np.int64)
        self.left, self.right = np.arange(size), np.arange(size)
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        pairs = np.array([[vocabulary[a], vocabulary[b], vocabulary[a + b]] for a, b in merges], dtype=np.int64)
        order = np.argsort(pairs[:, 0] * size + pairs[:, 1], kind="stable")
        self.keys, self.key_ranks = (pairs[:, 0] * size + pairs[:, 1])[order], order
        made = pairs[:, 2]
        if len(np.unique(made)) != len(made):
            raise ValueError("a token is made by two merges")
        self.rank[made], self.left[made], self.right[made] = np.arange(len(made)), pairs[:, 0], pairs[:, 1]
        # Tokens whose own text is really one token.
        valid = np.ones(size, dtype=bool)
        valid[made] = self._agree(pairs[:, 0], pairs[:, 1], np.arange(len(made), dtype=float))
        for token in made:
            valid[token] &= valid[self.left[token]] & valid[self.right[token]]
        edges: dict[int, int] = {}
        inner, final = [-1], [-1]
        for text, token in vocabulary.items():
            ends = text.endswith(suffix)
            body = text[:-len(suffix)] if ends else text
            if not valid[token] or not body or any(c not in byte_of for c in body):
                continue
            node = 0
            for c in body:
                key = node * 256 + byte_of[c]
                if key not in edges:
                    edges[key] = len(inner)
                    inner.append(-1)
                    final.append(-1)
                node = edges[key]
            (final if ends else inner)[node] = token
        self.longest = max((len(text) for text in vocabulary), default=1)
        self.edge_keys = np.array(sorted(edges), dtype=np.int64)
        self.edge_to = np.array([edges[k] for k in self.edge_keys.tolist()], dtype=np.int64)
        self.inner, self.final = np.array(inner), np.array(final)

    def _merge_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.key_ranks[at].astype(float), np.inf)

    def _agree(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether tokens next to each other stay as they are; with ``limit`` until that merge."""
        agree = np.ones(len(a), dtype=bool)
        active = np.arange(len(a))
        first = limit is not None
        limit = np.full(len(a), np.inf) if limit is None else limit.copy()
        while len(active):
            merged = self._merge_rank(a, b)
            bad = merged < limit
            if first:  # the pair's own merge is the limit
                bad[:] = False
                first = False
            agree[active[bad]] = False
            rank_a, rank_b = self.rank[a], self.rank[b]
            go = ~bad & ((rank_a >= 0) | (rank_b >= 0))
            active, a, b, rank_a, rank_b = active[go], a[go], b[go], rank_a[go], rank_b[go]
            # The later merge is undone; of equal ones the right, which was made last.
            undo = rank_a > rank_b
            # A pair as early as the left merge comes after it, one as early as the right before.
            limit = np.where(undo, rank_a, rank_b + 0.5)
            a, b = np.where(undo, self.right[a], a), np.where(undo, b, self.left[b])
        return agree

    def _agree_pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys, inverse = np.unique(a * self.size + b, return_inverse=True)
        return self._agree(keys // self.size, keys % self.size)[inverse]

    def _pick(self, words: np.ndarray, begins: np.ndarray, tokens: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Which of the candidate tokens is the last one of its word's prefix."""
        found = begins == 0
        rest = np.flatnonzero(~found)
        found[rest] = self._agree_pairs(last[words[rest], begins[rest]], tokens[rest])
        return found

    def counts(self, words: list[bytes]) -> np.ndarray:
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        out = np.zeros(len(words), dtype=np.int64)
        order = np.argsort(lengths, kind="stable")
        at, long = 0, int((lengths > 3 * OVERLAPS[0]).sum())
        for i in order[len(order) - long:].tolist():
            out[i] = self._long(words[i])
        order = order[:len(order) - long]
        while at < len(order):  # words of similar length step together
            top = max(16, 2 * int(lengths[order[at]]))
            to = int(np.searchsorted(lengths[order], top, side="right"))
            part = order[at:to]
            out[part] = self._steps([words[i] for i in part], lengths[part], np.ones(len(part), dtype=bool))[2]
            at = to
        return out

    def _long(self, word: bytes) -> int:
        for overlap in OVERLAPS:
            if len(word) > 3 * overlap and (found := self._scanned(word, 2 * overlap, overlap)) is not None:
                return found
        return int(self._steps([word], np.array([len(word)]), np.ones(1, dtype=bool))[2][0])

    def _scanned(self, word: bytes, chunk: int, overlap: int) -> int | None:
        """Count of a word read in chunks; None if neighbours disagree at a border."""
        starts = np.arange(0, len(word), chunk)
        begins = np.maximum(starts - overlap, 0)
        ends = np.minimum(starts + chunk, len(word))
        closed = ends == len(word)
        last, before, total = self._steps([word[a:b] for a, b in zip(begins, ends, strict=True)], ends - begins, closed)
        count = 0
        for c in range(1, len(starts)):
            border = np.arange(starts[c] - self.longest, starts[c] + 1)
            ahead, here = border - begins[c - 1], border - begins[c]
            added = before[c - 1, ahead] - before[c, here]
            if (last[c - 1, ahead] != last[c, here]).any() or (added != added[0]).any():
                return None
            count += int(added[0])
        return count + int(total[-1])

    def _steps(self, words: list[bytes], lengths: np.ndarray, closed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Last token and count for each prefix, and the counts of words that are ``closed``."""
        width = int(lengths.max(initial=0))
        matrix = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)
        last = np.zeros((len(words), width + 1), dtype=np.int64)
        before = np.zeros((len(words), width + 1), dtype=np.int64)
        total = np.zeros(len(words), dtype=np.int64)
        alive = np.zeros((3, 0), dtype=np.int64)  # word, start, node
        for i in range(width):
            fresh = np.flatnonzero(lengths > i)
            alive = np.concatenate([alive[:, lengths[alive[0]] > i], np.stack([fresh, np.full(len(fresh), i), np.zeros(len(fresh), np.int64)])], axis=1)
            keys = alive[2] * 256 + matrix[alive[0], i]
            at = np.minimum(np.searchsorted(self.edge_keys, keys), len(self.edge_keys) - 1)
            go = self.edge_keys[at] == keys
            alive = np.stack([alive[0][go], alive[1][go], self.edge_to[at[go]]])
            ending = (lengths[alive[0]] == i + 1) & closed[alive[0]]
            for table, here in ((self.inner, ~ending), (self.final, ending)):
                tokens = table[alive[2]]
                some = np.flatnonzero(here & (tokens >= 0))
                w, begin, tokens = alive[0][some], alive[1][some], tokens[some]
                took = self._pick(w, begin, tokens, last)
                w, begin, tokens = w[took], begin[took], tokens[took]
                if table is self.inner:
                    last[w, i + 1], before[w, i + 1] = tokens, before[w, begin] + 1
                else:
                    total[w] = before[w, begin] + 1
        return last, before, total


class TokenCounter:
    """Counts tokens of texts as the tokenizers library does for the same vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if steps != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("the normalizer is not one that was compiled")
        specials = [t["content"] for t in spec["added_tokens"]]
        self.specials = re.compile("|".join(map(re.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        self.splitter = Splitter()
        self.words = WordCounter(spec["model"])
        self.keys, self.known = np.zeros(0, U64), np.zeros(0, np.int64)

    def _normal(self, text: str) -> tuple[str, int]:
        extra = 0
        if self.specials and "<|" in text:
            text, extra = self.specials.subn(" ", text)
        if not text.isascii():
            # Lower-casing goes by character: no final form of sigma.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower(), extra

    def counts(self, texts: list[str]) -> np.ndarray:
        normal = [self._normal(t) for t in texts]
        joined = " ".join(t for t, _ in normal) + " "
        bounds = np.concatenate([[0], np.cumsum([len(t) + 1 for t, _ in normal])])
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        starts, ends = self.splitter.tokens(codes)
        powers, inverse = _radix_powers(len(codes) + 1)
        sums = np.zeros(len(codes) + 1, dtype=U64)
        np.cumsum((codes.astype(U64) + U64(1)) * U64(0xD6E8FEB86659FD93) * powers[:len(codes)], out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(U64))
        keys, example, inverse_of = np.unique(hashes, return_index=True, return_inverse=True)
        fresh = ~self._holds(keys)
        if fresh.any():
            if len(self.keys) + fresh.sum() > REMEMBERED:
                self.keys, self.known = np.zeros(0, U64), np.zeros(0, np.int64)
                fresh[:] = True
            found = self.words.counts([joined[starts[i]:ends[i]].encode() for i in example[fresh]])
            at = np.searchsorted(self.keys, keys[fresh])
            self.keys, self.known = np.insert(self.keys, at, keys[fresh]), np.insert(self.known, at, found)
        each = self.known[np.searchsorted(self.keys, keys)][inverse_of] if len(keys) else np.zeros(0, np.int64)
        ends_of = np.concatenate([[0], np.cumsum(each)])[np.searchsorted(starts, bounds)]
        return np.diff(ends_of) + np.array([e for _, e in normal], dtype=np.int64)

    def _holds(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), dtype=bool)
        return self.keys[np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)] == keys


_counters: dict[str, TokenCounter] = {}


def counter_of(path: str) -> TokenCounter:
    """One compiled tokenizer per Python worker and vocabulary file."""
    if path not in _counters:
        _counters[path] = TokenCounter(path)
    return _counters[path]


def token_count(text: Column, path: str) -> Column:
    """Number of tokens of a text column, without special tokens at its ends; null counts 0."""

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        counter = counter_of(path)
        parts, held, size = [], [], 0
        for value in texts:
            text = value.as_py() or ""
            held.append(text)
            size += len(text) + 1
            if size >= SLICE_CHARS:
                parts.append(counter.counts(held))
                held, size = [], 0
        if held:
            parts.append(counter.counts(held))
        return pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64), pa.int64())

    return count(text.cast("string"))


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit (over 2048 tokens).

    Defined for every input: null reads as empty, with no bytes and no tokens; special tokens'
    strings inside a text count one each; repeated rows give equal rows; an empty table gives
    an empty result; columns other than doc_id and text are not read. A text is read whole; a
    task holds about ``SLICE_CHARS`` characters or one longer text, and for a long word some
    thirty bytes a byte of it.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), token_count(text, path).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > LIMIT)
