"""Byte-level BPE by speculation and verification.

A text is cut into words by the published byte-level pattern, evaluated on whole batches at once:
code points are mapped to four classes and word starts follow from class changes.  Each distinct
word is then encoded once per worker:

1. *Speculate*: greedy longest match over the vocabulary proposes tokens (Aho-Corasick, all new
   words of a batch in one pass).
2. *Verify*: a proposal equals the merge result exactly when every token encodes to itself and
   every adjacent pair (a, b) encodes to [a, b].  Pairs are coded as one integer, looked up
   together, and only pairs never seen before are worked out (by exact merging of the two tokens).
3. *Repair*: only words with a failing pair are merged exactly.

Decoding concatenates the byte strings of the ids, again for a batch at once.

Defined results: null and empty texts give no ids; the text of a special token becomes its id, as
the tokenizers library does by default; very long texts are encoded whole; repeated rows and extra
columns have no influence; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakelet.llm.common import map_arrow, slices, word_hashes

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
#: distinct words kept per worker before the cache starts anew
CACHE_WORDS = 1_500_000
#: characters worked on at a time; a longer text is cut where a word surely starts
LONG = 1_000_000


@lru_cache(maxsize=1)
def code_classes() -> np.ndarray:
    """Class of every code point, by the Unicode properties that the pattern names."""
    import regex

    out = np.full(0x110000, OTHER, dtype=np.uint8)
    every = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
    for cls, prop in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        hit = "".join(regex.findall(prop, every))
        out[np.frombuffer(hit.encode("utf-32-le"), dtype=np.uint32)] = cls
    return out


def word_starts(cp: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Mark the code points that start a word.  ``cp``: code points of concatenated texts; ``first``:
    True where a text starts."""
    n = len(cp)
    cls = code_classes()[cp]
    start = first.copy()
    start[1:] |= cls[1:] != cls[:-1]
    # the last blank of a run that a word follows in the same text stands apart from the run,
    # and a plain space joins the word
    last = np.zeros(n, dtype=bool)
    last[:-1] = (cls[:-1] == SPACE) & (cls[1:] != SPACE) & ~first[1:]
    start |= last
    joins = np.flatnonzero(last & (cp == 32)) + 1
    start[joins] = False
    # contractions: an apostrophe that starts a word takes s t m d / re ve ll with it
    at = np.flatnonzero((cp == 39) & start)
    if len(at):
        def nxt(k: int) -> np.ndarray:
            i = at + k
            ok = i < n
            for j in range(1, k + 1):
                ok &= ~first[np.minimum(at + j, n - 1)]
            return np.where(ok, cp[np.minimum(i, n - 1)], 0)

        one, two = nxt(1), nxt(2)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        for hit, k in ((at[short], 2), (at[long], 3)):
            start[hit + 1] = False
            ends = hit + k
            start[ends[ends < n]] = True
    return start


#: a lone space between two visible characters starts a word whatever surrounds it
_CUT = re.compile(r"(?<=\S) (?=\S)")


class ByteBPE:
    """Encoder and decoder for one vocabulary file of the tokenizers library (byte-level BPE)."""

    def __init__(self, path: str):
        import ahocorasick

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        # printable bytes stand for themselves in the file, the others for code points from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        to_byte = {chr(b): b for b in plain}
        to_byte |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = {t: i for t, i in model["vocab"].items() if t not in self.special}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.token: list[bytes] = [b""] * size
        for t, i in vocab.items():
            self.token[i] = bytes(to_byte[c] for c in t)
        for t, i in self.special.items():
            self.token[i] = t.encode()
        ids = {self.token[i]: i for i in vocab.values()}
        self.byte_id = np.array([ids[bytes([b])] for b in range(256)], dtype=np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        code = np.array([vocab[a] * size + vocab[b] for a, b in merges], dtype=np.int64)
        self.rule_new = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)  # by rank
        self.rule_code, self.rule_rank = np.unique(code, return_index=True)
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.longest = ahocorasick.Automaton()
        for i in vocab.values():
            self.longest.add_word(self.token[i].decode("latin-1"), i)
        self.longest.make_automaton()
        lens = np.array([len(t) for t in self.token], dtype=np.int64)
        self.token_len, self.token_at = lens, np.concatenate([[0], np.cumsum(lens)])
        self.token_bytes = np.frombuffer(b"".join(self.token), dtype=np.uint8)
        self.pair_codes = np.empty(0, dtype=np.int64)  # sorted
        self.pair_fits = np.empty(0, dtype=bool)
        self.repaired = self.encoded = 0
        self._reset()

    def _reset(self) -> None:
        self.word_hash = np.empty(0, dtype=np.uint64)  # sorted
        self.word_no = np.empty(0, dtype=np.int64)  # of each hash, into word_at
        self.word_at = np.zeros(1, dtype=np.int64)
        self.word_ids = np.empty(0, dtype=np.int32)

    def _numbers(self, hashes: np.ndarray, data: bytes, bounds: np.ndarray) -> np.ndarray:
        """The number of each word in the cache; words not in it are encoded and added."""
        uniq, first, where = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.word_hash) > CACHE_WORDS:
            self._reset()
        at = np.searchsorted(self.word_hash, uniq)
        known = np.zeros(len(uniq), dtype=bool)
        if len(self.word_hash):
            known = self.word_hash[np.minimum(at, len(self.word_hash) - 1)] == uniq
        number = np.empty(len(uniq), dtype=np.int64)
        number[known] = self.word_no[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            lo, hi = bounds[first[new]].tolist(), bounds[first[new] + 1].tolist()
            ids, counts = self.encode_words([data[a:b] for a, b in zip(lo, hi)])
            number[new] = np.arange(len(new)) + len(self.word_at) - 1
            self.word_ids = np.concatenate([self.word_ids, ids])
            self.word_at = np.concatenate([self.word_at, self.word_at[-1] + np.cumsum(counts)])
            self.word_hash = np.insert(self.word_hash, at[new], uniq[new])
            self.word_no = np.insert(self.word_no, at[new], number[new])
        return number[where]

    # -- exact merging -------------------------------------------------------------------------
    def _rules(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The number of the merge rule of each pair (its rank); ``len(self.rule_code)`` where there is none."""
        code = a * len(self.token) + b
        i = np.minimum(np.searchsorted(self.rule_code, code), len(self.rule_code) - 1)
        return np.where(self.rule_code[i] == code, self.rule_rank[i], len(self.rule_code))

    def merge_exactly(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Merge all words at once, in rounds: each word applies its lowest-ranked rule wherever the
        pair stands, from the left.  Returns the ids of all words, concatenated, and their counts."""
        lens = np.array([len(w) for w in words], dtype=np.int64)
        sym = self.byte_id[np.frombuffer(b"".join(words), dtype=np.uint8)]
        word = np.repeat(np.arange(len(words)), lens)
        none = len(self.rule_code)
        done_word, done_sym = [], []
        rank = np.full(len(sym), none)  # of the pair that starts at each symbol
        at = np.flatnonzero(word[1:] == word[:-1])
        rank[at] = self._rules(sym[at], sym[at + 1])
        while len(sym):
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            low = np.minimum.reduceat(rank, first)
            size = np.diff(np.append(first, len(sym)))
            low_of = np.repeat(low, size)
            over = low_of == none
            if over.any():  # words without a rule are finished
                done_word.append(word[over])
                done_sym.append(sym[over])
                stay = ~over
                sym, word, rank, low_of = sym[stay], word[stay], rank[stay], low_of[stay]
                continue
            hit = np.flatnonzero(rank == low_of)
            # in a run of one symbol the pairs overlap: every other one counts, from the left
            new_run = np.append(True, (np.diff(hit) > 1) | (word[hit[1:]] != word[hit[:-1]]))
            run_start = np.flatnonzero(new_run)
            nth = np.arange(len(hit)) - np.repeat(run_start, np.diff(np.append(run_start, len(hit))))
            hit = hit[nth % 2 == 0]
            sym[hit] = self.rule_new[rank[hit]]
            stay = np.ones(len(sym), dtype=bool)
            stay[hit + 1] = False
            kept_at = np.cumsum(stay) - 1
            sym, word, rank = sym[stay], word[stay], rank[stay]
            at = kept_at[hit]
            at = np.unique(np.concatenate([at, at[at > 0] - 1]))
            rank[at] = none
            at = at[at + 1 < len(sym)]
            at = at[word[at] == word[at + 1]]
            rank[at] = self._rules(sym[at], sym[at + 1])
        if not done_sym:
            return np.empty(0, dtype=np.int64), np.zeros(len(words), dtype=np.int64)
        word = np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return np.concatenate(done_sym)[order], np.bincount(word, minlength=len(words))

    # -- speculate and verify ------------------------------------------------------------------
    def _fits(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair: does (a, b) stay as it is under merging?  b = -1 tests a alone."""
        codes = (a.astype(np.int64) << 32) | (b.astype(np.int64) + 1)
        uniq, where = np.unique(codes, return_inverse=True)
        if len(self.pair_codes):
            i = np.minimum(np.searchsorted(self.pair_codes, uniq), len(self.pair_codes) - 1)
            new = uniq[self.pair_codes[i] != uniq]
        else:
            new = uniq
        if len(new):
            x, y = new >> 32, (new & 0xFFFFFFFF) - 1
            got, n = self.merge_exactly([self.token[i] + (self.token[j] if j >= 0 else b"") for i, j in zip(x.tolist(), y.tolist())])
            at = np.cumsum(n) - n
            fits = (n == 1 + (y >= 0)) & (got[at] == x) & ((y < 0) | (got[np.minimum(at + 1, len(got) - 1)] == y))
            codes_all = np.concatenate([self.pair_codes, new])
            order = np.argsort(codes_all)
            self.pair_codes = codes_all[order]
            self.pair_fits = np.concatenate([self.pair_fits, fits])[order]
        return self.pair_fits[np.searchsorted(self.pair_codes, uniq)][where]

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, concatenated, and the number of ids of each word."""
        lens = np.array([len(w) for w in words], dtype=np.int64)
        ends = np.cumsum(lens + 1) - 1  # of each word in the joined text
        text = "Ā".join([w.decode("latin-1") for w in words])
        found = np.array([x for hit in self.longest.iter_long(text) for x in hit], dtype=np.int64).reshape(-1, 2)
        ids, owner = found[:, 1], np.searchsorted(ends, found[:, 0])
        good = np.bincount(owner, weights=self.token_len[ids], minlength=len(words)).astype(np.int64) == lens
        same = owner[1:] == owner[:-1]
        left = np.flatnonzero(same)
        bad_pair = left[~self._fits(ids[left], ids[left + 1])] if len(left) else left
        good[owner[bad_pair]] = False
        if len(ids):
            good[owner[~self._fits(ids, np.full(len(ids), -1))]] = False
        counts = np.bincount(owner, minlength=len(words))
        self.encoded += len(words)
        wrong = np.flatnonzero(~good)
        if len(wrong):
            self.repaired += len(wrong)
            fixed, fixed_counts = self.merge_exactly([words[w] for w in wrong.tolist()])
            keep = good[owner]
            owner = np.concatenate([owner[keep], np.repeat(wrong, fixed_counts)])
            ids = np.concatenate([ids[keep], fixed])[np.argsort(owner, kind="stable")]
            counts[wrong] = fixed_counts
        return ids.astype(np.int32), counts

    def _encode_pieces(self, pieces: list[str], counts: np.ndarray) -> np.ndarray:
        """Ids of the pieces, concatenated; puts the number of each piece's ids into ``counts``."""
        whole = "".join(pieces)
        if not whole:
            return np.empty(0, dtype=np.int32)
        cp = np.frombuffer(whole.encode("utf-32-le"), dtype=np.uint32)
        ends = np.cumsum([len(p) for p in pieces])
        first = np.zeros(len(cp) + 1, dtype=bool)
        first[np.append(0, ends[:-1])] = True
        starts = np.flatnonzero(word_starts(cp, first[:-1]))
        width = np.ones(len(cp), dtype=np.int8)
        for least in (0x80, 0x800, 0x10000):
            width += cp >= least
        bounds = np.concatenate([[0], np.cumsum(width, dtype=np.int64)])[np.append(starts, len(cp))]
        data = whole.encode()
        index = self._numbers(word_hashes(np.frombuffer(data, dtype=np.uint8), bounds[:-1], bounds[1:]), data, bounds)
        n = self.word_at[index + 1] - self.word_at[index]
        counts += np.bincount(np.searchsorted(ends, starts, side="right"), weights=n, minlength=len(pieces)).astype(np.int64)
        return self.word_ids[ranges(self.word_at[index], n)]

    def encode_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, concatenated, and the offsets of each text in them (one more than texts)."""
        pieces, owner, marks = [], [], []  # marks: special id that follows a piece, or -1
        for k, t in enumerate(texts):
            if not t:
                continue
            parts = self.split.split(t) if self.split and any(s in t for s in self.special) else [t]
            for j in range(0, len(parts), 2):
                cut = 0
                while len(parts[j]) - cut > LONG and (m := _CUT.search(parts[j], cut + LONG)):
                    pieces.append(parts[j][cut:m.start()])
                    owner.append(k)
                    marks.append(-1)
                    cut = m.start()
                pieces.append(parts[j][cut:])
                owner.append(k)
                marks.append(self.special[parts[j + 1]] if j + 1 < len(parts) else -1)
        counts = np.zeros(len(pieces), dtype=np.int64)
        flats, lo, size = [], 0, 0
        for i, piece in enumerate(pieces):  # groups of pieces of bounded size
            size += len(piece)
            if size >= LONG or i + 1 == len(pieces):
                flats.append(self._encode_pieces(pieces[lo:i + 1], counts[lo:i + 1]))
                lo, size = i + 1, 0
        flat = np.concatenate(flats) if flats else np.empty(0, dtype=np.int32)
        if any(m >= 0 for m in marks):
            at = np.cumsum(counts)
            has = np.array(marks) >= 0
            flat = np.insert(flat, at[has], np.array(marks, dtype=np.int32)[has])
            counts += has
        per_text = np.bincount(np.array(owner, dtype=np.int64), weights=counts, minlength=len(texts)).astype(np.int64) if pieces else np.zeros(len(texts), dtype=np.int64)
        return flat, np.concatenate([[0], np.cumsum(per_text)])

    def decode(self, ids: np.ndarray) -> bytes:
        return self.token_bytes[ranges(self.token_at[ids], self.token_len[ids])].tobytes()


class RankedBPE(ByteBPE):
    """The same ids, with new words encoded by tiktoken's merge loop over the vocabulary's rank file."""

    def __init__(self, path: str, ranks_path: str):
        import base64

        import tiktoken

        super().__init__(path)
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
        self.core = tiktoken.Encoding("ranks", pat_str=r"\s+|\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids = [self.core.encode_single_piece(w) for w in words]
        counts = np.array([len(x) for x in ids], dtype=np.int64)
        return np.fromiter((t for x in ids for t in x), dtype=np.int32, count=int(counts.sum())), counts


def ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of each run, concatenated."""
    total = int(lens.sum())
    if not total:
        return np.empty(0, dtype=np.int64)
    ends = np.cumsum(lens)
    return np.arange(total) + np.repeat(starts - (ends - lens), lens)


@lru_cache(maxsize=2)
def load(path: str) -> ByteBPE:
    return ByteBPE(path)


@lru_cache(maxsize=2)
def load_ranked(path: str, ranks_path: str) -> RankedBPE:
    return RankedBPE(path, ranks_path)


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>, decoded string): ids of each whole text and the text decoded from them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        bpe = load(tokenizer)
        for rows, texts in slices(batches):
            flat, at = bpe.encode_batch(texts)
            yield {"doc_id": rows.column(0), "ids": pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat, pa.int32())),
                   "decoded": [bpe.decode(flat[a:b]).decode("utf-8", "replace") for a, b in zip(at, at[1:])]}

    return map_arrow(docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")), run,
                     "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): the digest of ``encode`` without its long columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        bpe = load(tokenizer)
        for rows, texts in slices(batches):
            flat, at = bpe.encode_batch(texts)
            own = [flat[a:b] for a, b in zip(at, at[1:])]
            yield {"doc_id": rows.column(0), "n_tokens": np.diff(at),
                   "ids_sha256": [hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in own],
                   "decoded_sha256": [hashlib.sha256(bpe.decode(x)).hexdigest() for x in own]}

    return map_arrow(docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")), run,
                     "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
