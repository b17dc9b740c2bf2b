"""Vocabulary automaton: every occurrence of every token in a word by one walk.

The tokens become a trie in three flat arrays: the sorted keys ``state << 21 | code
point`` of its edges, the state each edge leads to, and the token id that ends at a
state (or -1). A batch of words is one array of code points; all positions walk the
trie together, a step per character, and drop out where no edge leads on. No substring
is made and nothing is joined.

The arrays go to the executors only if the vocabulary has at most ``MAX_TOKENS`` tokens
of ``MAX_CHARS`` characters in all (both counted first) and no token twice; ``compiled``
gives None otherwise, and the callers join substrings with the vocabulary instead.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_TOKENS, MAX_CHARS = 200_000, 4_000_000
#: characters walked at a time
WALK_CHARS = 1 << 18
#: code points lie below 2**21
CODE_BITS = 21


def build(tokens: list[tuple[str, int]], scores: dict[int, float] | None = None) -> tuple:
    """The trie of ``(token, id)`` as plain arrays ``(keys, targets, token_at, scores)``,
    ``scores`` by token id or None; empty tokens match nothing."""
    children: dict[int, int] = {}
    token_at = [-1]
    for token, token_id in tokens:
        state = 0
        for ch in token:
            key = state << CODE_BITS | ord(ch)
            state = children.setdefault(key, len(token_at))
            if state == len(token_at):
                token_at.append(-1)
        if token:
            token_at[state] = token_id
    keys = np.fromiter(children.keys(), dtype=np.int64, count=len(children))
    targets = np.fromiter(children.values(), dtype=np.int64, count=len(children))
    order = np.argsort(keys)
    table = None
    if scores is not None:
        table = np.full(max(scores, default=0) + 1, np.nan)
        table[list(scores)] = list(scores.values())
    return keys[order], targets[order], np.asarray(token_at, dtype=np.int64), table


def compiled(vocab: DataFrame) -> tuple | None:
    """The automaton of ``vocab(id, token[, score])``, or None beyond its bounds."""
    slim = vocab.select("id", "token", *[c for c in vocab.columns if c == "score"]).where(F.col("token").isNotNull())
    n, chars = slim.limit(MAX_TOKENS + 1).agg(F.count(F.lit(1)), F.sum(F.length("token"))).first()
    if n > MAX_TOKENS or (chars or 0) > MAX_CHARS:
        return None
    rows = slim.collect()  # bounded by the line above
    if len({r["token"] for r in rows}) < len(rows):
        return None
    scores = {r["id"]: r["score"] for r in rows} if "score" in slim.columns else None
    return build([(r["token"], r["id"]) for r in rows], scores)


def matcher():
    """A function ``(automaton, words) -> (start, size, id, ends)`` of arrays: matches
    ordered by start and size, starts counted over all words joined, and the end of
    every word; nested, so that it is shipped by value."""
    code_bits = CODE_BITS

    def matches(automaton, words):
        keys, targets, token_at, _ = automaton
        lengths = np.fromiter((len(w) for w in words), dtype=np.int64, count=len(words))
        text = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        ends = np.cumsum(lengths)
        stop = np.repeat(ends, lengths)
        at = np.arange(len(text))                       # where the walks that still run have begun
        state = np.zeros(len(text), dtype=np.int64)
        found = [(at[:0], at[:0], at[:0])]
        depth = 0
        while len(at) and len(keys):
            inside = at + depth < stop[at]
            at, state = at[inside], state[inside]
            key = state << code_bits | text[at + depth]
            edge = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            leads = keys[edge] == key
            at, state = at[leads], targets[edge[leads]]
            depth += 1
            hit = token_at[state] >= 0
            found.append((at[hit], np.full(int(hit.sum()), depth), token_at[state[hit]]))
        start, size, token = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((size, start))
        return start[order], size[order], token[order], ends

    return matches


def chunker():
    """A function that cuts a list of words into stretches of at most ``WALK_CHARS``
    characters (one word at least)."""
    limit = WALK_CHARS

    def chunks(words):
        part, chars = [], 0
        for w in words:
            if part and chars + len(w) > limit:
                yield part
                part, chars = [], 0
            part.append(w)
            chars += len(w)
        if part:
            yield part

    return chunks
