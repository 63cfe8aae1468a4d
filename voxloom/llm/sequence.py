"""Linear-chain tagging of many token sequences at once."""

from __future__ import annotations

import numpy as np


def viterbi(emit: np.ndarray, lengths: np.ndarray, trans: np.ndarray, first: np.ndarray | None = None) -> np.ndarray:
    """The best tag of every token.

    ``emit`` holds one row of tag scores per token, sequence after sequence; ``lengths`` the tokens of each sequence;
    ``trans[p, c]`` scores tag c after tag p; ``first`` is added at the start of a sequence. All sequences advance together,
    longest first, so the work is a few array operations per position and not a loop per token.
    """
    n, s = emit.shape
    tags = np.zeros(n, np.int8)
    if n == 0:
        return tags
    starts = np.cumsum(lengths) - lengths
    by_length = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[by_length], lengths[by_length]
    alive = np.searchsorted(-lengths, -np.arange(int(lengths[0])), side="left")  # sequences longer than t
    back = np.zeros((n, s), np.int8)
    score = emit[starts[: alive[0]]].astype(np.float32)
    if first is not None:
        score = score + first
    ends = np.zeros((len(lengths), s), np.float32)
    for t in range(1, len(alive)):
        k = alive[t]
        if k < len(score):
            ends[k : len(score)] = score[k:]
            score = score[:k]
        if k < 512:  # few sequences: one array over both tags; else one tag after the other, in less memory
            both = score[:, :, None] + trans
            frm = both.argmax(1).astype(np.int8)
            best = both.max(1)
        else:
            best = score[:, :1] + trans[0]
            frm = np.zeros((k, s), np.int8)
            for p in range(1, s):
                c = score[:, p : p + 1] + trans[p]
                better = c > best
                np.copyto(best, c, where=better)
                frm[better] = p
        at = starts[:k] + t
        back[at] = frm
        score = best + emit[at]
    ends[: len(score)] = score
    tag = ends.argmax(1).astype(np.int8)
    for t in range(len(alive) - 1, -1, -1):
        k = alive[t]
        at = starts[:k] + t
        tags[at] = tag[:k]
        tag[:k] = back[at, tag[:k]]
    return tags


def train(
    sequences: list[tuple[np.ndarray, np.ndarray]], features: list[np.ndarray], n_features: int, n_tags: int, epochs: int = 8, seed: int = 7, batch: int = 16
):
    """Weights of a tagger over token features, by the averaged structured perceptron with a margin, in small batches.

    ``sequences`` holds (tokens, tags); ``features[token]`` the features of a token. A token's score for a tag is the sum of
    weights for its own features, for those of the token before and for those of the token after it; tags are tied by
    transition weights. Returns (own, before, after, trans), the first three with one row per feature.
    """
    rng = np.random.default_rng(seed)
    width = max(map(len, features), default=1)
    of = np.full((len(features) + 1, width), n_features)  # a row of zero weights fills up; the last token is the edge
    for i, f in enumerate(features):
        of[i, : len(f)] = f
    w = [np.zeros((n_features + 1, n_tags)) for _ in range(3)] + [np.zeros((n_tags, n_tags))]
    late = [np.zeros_like(x) for x in w]  # updates times the step they came at, for the average
    edge, step = len(features), 0
    for _ in range(epochs):
        order = rng.permutation(len(sequences))
        for k in range(0, len(order), batch):
            some = [sequences[i] for i in order[k : k + batch]]
            lengths = np.array([len(g) for _, g in some])
            tokens, gold = (np.concatenate(x) for x in zip(*some, strict=True))
            first = np.zeros(len(gold) + 1, bool)
            first[np.cumsum(lengths) - lengths] = first[-1] = True
            inner = ~first[1:-1]  # pairs of neighbours in one sequence
            parts = [of[tokens], of[np.where(first[:-1], edge, np.r_[edge, tokens[:-1]])], of[np.where(first[1:], edge, np.r_[tokens[1:], edge])]]
            emit = sum(x[at].sum(1) for x, at in zip(w, parts, strict=False)) + 1.0
            emit[np.arange(len(gold)), gold] -= 1.0
            guess = viterbi(emit.astype(np.float32), lengths, w[3].astype(np.float32))
            wrong = np.flatnonzero(guess != gold)
            for tag, sign in ((gold, 1.0), (guess, -1.0)) if len(wrong) else ():
                for x, y, at in zip(w, late, parts, strict=False):
                    where = (at[wrong], tag[wrong][:, None])
                    np.add.at(x, where, sign)
                    np.add.at(y, where, sign * step)
                    x[n_features] = y[n_features] = 0
                pairs = (tag[:-1][inner], tag[1:][inner])
                np.add.at(w[3], pairs, sign)
                np.add.at(late[3], pairs, sign * step)
            step += 1
    average = [(x - y / max(1, step)).astype(np.float32) for x, y in zip(w, late, strict=True)]
    return average[0][:-1], average[1][:-1], average[2][:-1], average[3]


def shifted_sum(own: np.ndarray, before: np.ndarray, after: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Tag scores of every token: its own, what the token before it says and what the token after it says."""
    out = own.copy()
    if len(out) > 1:
        ends = np.cumsum(lengths)[lengths > 0]
        first, last = np.zeros(len(out), bool), np.zeros(len(out), bool)
        first[ends - lengths[lengths > 0]] = True
        last[ends - 1] = True
        out[1:] += np.where(first[1:, None], 0, before[:-1])
        out[:-1] += np.where(last[:-1, None], 0, after[1:])
    return out
