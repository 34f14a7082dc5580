"""Hashed character and word n-grams of whole texts, one block at a time."""

from __future__ import annotations

import numpy as np

from tallyhouse.llm.text import Block, find_words, gram_hash, prefix_hash, span_hash, window_hashes


REPEAT = 40_503


def character_grams(block: Block, sizes, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and document of each n-gram of bytes that lies in one document, for every size."""
    doc = np.repeat(np.arange(len(block)), block.lengths)
    features, docs = [], []
    for n in sizes:
        hashes = gram_hash(block.data, n)
        same = doc[:len(hashes)] == doc[n - 1:] if len(hashes) else np.zeros(0, bool)
        salted = hashes[same] + np.uint64(n)
        features.append((salted % np.uint64(buckets)).astype(np.int64))
        docs.append(doc[:len(hashes)][same])
    return np.concatenate(features), np.concatenate(docs)


def word_grams(block: Block, sizes, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and document of each run of words, for every size.

    A word equal to the one before it also counts as a gram of its own kind, whatever the word is.
    """
    words = find_words(block)
    hashes = span_hash(prefix_hash(block.data), words.starts, words.ends)
    features, docs = [], []
    for n in sizes:
        runs, first = window_hashes(hashes, words.doc, n)
        features.append(((runs + np.uint64(n)) % np.uint64(buckets)).astype(np.int64))
        docs.append(words.doc[first])
    again = np.flatnonzero((hashes[1:] == hashes[:-1]) & (words.doc[1:] == words.doc[:-1]))
    features.append(np.full(len(again), REPEAT % buckets))
    docs.append(words.doc[again])
    return np.concatenate(features), np.concatenate(docs)


def mean_of(values: np.ndarray, docs: np.ndarray, n_docs: int, neutral: int = 0) -> np.ndarray:
    """Mean of the rows of ``values`` and ``neutral`` rows of zeros per document; zero where it has none."""
    values = values.reshape(len(values), -1)
    total = np.stack([np.bincount(docs, values[:, k], minlength=n_docs) for k in range(values.shape[1])], 1)
    return total / np.maximum(np.bincount(docs, minlength=n_docs) + neutral, 1)[:, None]


def counted(features: np.ndarray, docs: np.ndarray, n_docs: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per document the distinct buckets and how often each occurs."""
    order = np.argsort(docs, kind="stable")
    cuts = np.searchsorted(docs[order], np.arange(n_docs + 1))
    return [np.unique(features[order[a:b]], return_counts=True) for a, b in zip(cuts, cuts[1:])]
