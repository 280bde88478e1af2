"""BPE encoding and decoding by speculation and verification.

For tokenizer files of the kind ``word_bpe_49k.json``: a text is brought to NFC, runs of
white space become one space, letters are lowered; a pattern finds the words; a word is the
byte-level symbols of its UTF-8 bytes, the last one marked as a word end; merges apply in
the order of their rank, leftmost first.

1. *Speculate*: a word is cut greedily into the longest tokens of a trie, all words of a
   block of texts at once (``Merges.propose``).
2. *Verify*: a cut is what merging gives if each of its tokens is reached from its own
   symbols and no two neighbours would have merged across their border.  ``compatible``
   steps both sides of all borders back through the merges that made them, latest first,
   and looks up whether the symbols then standing at the border merge earlier.
3. Only words with a failing border are merged step by step (``Merges.merge_short``, and
   ``merge`` for long ones).

Each distinct word of a block of texts is cut once; blocks close at ``block_chars``
characters, so that a task holds a bounded part of its rows.  There is no shuffle.

Decoding joins the texts of the tokens by one space, as a file without a decoder asks for.

Null and empty texts, and texts of white space alone, have no tokens and decode to the empty
text.  Strings of special tokens are those tokens.  Repeated rows and ids each give a row,
other columns are left out, an empty table gives no row.
"""

from __future__ import annotations

import heapq
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_CHARS = 12_000_000
#: Tokens of one output batch, and of one step of decoding.
BATCH_TOKENS = 400_000
END = 256
NEVER = np.iinfo(np.int64).max
#: Failing words of more symbols are merged one by one, by a queue, in n log n steps.
SHORT = 64

#: What the supported files state.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SUFFIX = "</w>"

#: The same pattern for lower-case texts below U+0080 and below U+0250, where no version of
#: Unicode differs in letters, numbers and composition; a line end is a word of its own.
_PLAIN_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+|\n")
_LATIN_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\t-\r \x85\xa0\p{L}\p{N}]+|\n")
_LATIN = re.compile("[\0-ɏ]*")


def byte_symbols() -> dict[str, int]:
    """Characters that stand for bytes: a printable Latin-1 byte for itself, the others by
    the characters from U+0100 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def spans(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indices of the stretches ``starts[i] .. starts[i] + lens[i]``, one after another."""
    before = np.cumsum(lens) - lens
    return np.repeat(starts - before, lens) + np.arange(int(lens.sum()))


class Merges:
    """Trie, pair table and splits of a vocabulary.  Symbols are bytes, plus ``END`` at the
    end of a word."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        n = max(vocab.values()) + 1
        self.rank, self.left, self.right = (np.full(n, -1, np.int64) for _ in range(3))
        symbols: dict[int, tuple] = {}
        for text, byte in byte_symbols().items():
            symbols[vocab[text]], symbols[vocab[text + SUFFIX]] = (byte,), (byte + END,)
        self.base = np.empty(2 * END, np.int64)
        for i, s in symbols.items():
            self.base[s[0]] = i
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for r, (a, b) in enumerate(merges):
            x, y, t = vocab[a], vocab[b], vocab[a + b]
            if t in symbols or x not in symbols or y not in symbols:
                raise ValueError(f"merge {r} gives a token twice, or from tokens that later merges make")
            symbols[t] = symbols[x] + symbols[y]
            self.rank[t], self.left[t], self.right[t] = r, x, y
            self.pairs[x, y] = r, t
        keys = np.fromiter((x * n + y for x, y in self.pairs), np.int64, len(self.pairs))
        order = np.argsort(keys)
        self.n, self.keys = n, np.append(keys[order], NEVER)
        self.key_rank = np.append(np.arange(len(keys))[order], NEVER)
        self.key_token = np.append(np.fromiter((t for _, t in self.pairs.values()), np.int64, len(keys))[order], -1)
        self.reached = self._reached()
        self._build_trie({s: t for t, s in symbols.items() if self.reached[t]})

    def _reached(self) -> np.ndarray:
        """Tokens that merging their own symbols gives."""
        made = np.flatnonzero(self.rank >= 0)
        made = made[np.argsort(self.rank[made])]
        at = self.rank[made]
        fine = np.ones(self.n, bool)
        fine[made] = self.compatible(self.left[made], self.right[made], at, at)
        changed = True
        while changed:  # parts made of unreached tokens, as deep as they nest
            now = fine.copy()
            now[made] &= fine[self.left[made]] & fine[self.right[made]]
            changed, fine = bool((now != fine).any()), now
        return fine

    def _build_trie(self, tokens: dict[tuple, int]) -> None:
        children, accept = {}, [-1]
        for s, t in tokens.items():
            node = 0
            for c in s:
                key = node * 2 * END + c
                if key not in children:
                    children[key] = len(accept)
                    accept.append(-1)
                node = children[key]
            accept[node] = t
        keys = np.fromiter(children, np.int64, len(children))
        order = np.argsort(keys)
        self.step_keys = np.append(keys[order], NEVER)
        self.step_to = np.append(np.fromiter(children.values(), np.int64, len(children))[order], 0)
        self.accept = np.array(accept, np.int64)

    def compatible(self, u: np.ndarray, v: np.ndarray, until_u=NEVER, until_v=NEVER) -> np.ndarray:
        """Whether tokens ``u[i]``, ``v[i]`` next to each other stay apart.  ``until``: the rank
        of the merge that takes the piece at the border into a larger one.  A merge over
        the border goes first if its rank is below that on the left, where an equal merge
        stands further left and so comes first, and not above that on the right."""
        u, v = u.astype(np.int64), v.astype(np.int64)
        p, q = (np.broadcast_to(np.asarray(x, np.int64), u.shape).copy() for x in (until_u, until_v))
        fine, live = np.ones(len(u), bool), np.arange(len(u))
        while len(live):
            key = u * self.n + v
            at = np.searchsorted(self.keys, key)
            r = np.where(self.keys[at] == key, self.key_rank[at], NEVER)
            clash = (r < p) & (r <= q) & (r < NEVER)
            fine[live[clash]] = False
            ru, rv = self.rank[u], self.rank[v]
            go = ~clash & ((ru >= 0) | (rv >= 0))
            u, v, p, q, live, ru, rv = (x[go] for x in (u, v, p, q, live, ru, rv))
            undo_u = ru > rv
            p, q = np.where(undo_u, ru, p), np.where(undo_u, q, rv)
            u, v = np.where(undo_u, self.right[u], u), np.where(undo_u, v, self.left[v])
        return fine

    def longest(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The longest token from every place of symbols ``s``, and its length.  No token has
        a word end before its last symbol, so none crosses words."""
        token, length = self.base[s], np.ones(len(s), np.int64)
        live, node, depth = np.arange(len(s)), np.zeros(len(s), np.int64), 0
        while len(live):
            key = node * 2 * END + s[live + depth]
            at = np.searchsorted(self.step_keys, key)
            found = self.step_keys[at] == key
            live, node, depth = live[found], self.step_to[at[found]], depth + 1
            t = self.accept[node]
            ends = t >= 0
            token[live[ends]], length[live[ends]] = t[ends], depth
            inside = live + depth < len(s)
            live, node = live[inside], node[inside]
        return token, length

    def propose(self, s: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy tokens of the words ``s[starts[i]:ends[i]]`` in order, and the word of each."""
        token, length = self.longest(s)
        taken = np.zeros(len(s), bool)
        at, stop = starts, ends
        while len(at) > 64:
            taken[at] = True
            at = at + length[at]
            go = at < stop
            at, stop = at[go], stop[go]
        for i, e in zip(at.tolist(), stop.tolist()):  # the longest few words
            steps, places = length[i:e].tolist(), []
            j, n = 0, e - i
            while j < n:
                places.append(j)
                j += steps[j]
            taken[i + np.array(places, np.int64)] = True
        where = np.flatnonzero(taken)
        return token[where], np.searchsorted(ends, where, side="right")

    def merge(self, symbols: list[int]) -> list[int]:
        """Tokens of one word by merging the pair of lowest rank, leftmost first."""
        ids = self.base[symbols].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = self.pairs
        queue = [(*pairs[ids[i], ids[i + 1]], i, ids[i], ids[i + 1]) for i in range(n - 1) if (ids[i], ids[i + 1]) in pairs]
        queue = [(r, i, t, x, y) for r, t, i, x, y in queue]
        heapq.heapify(queue)
        while queue:
            r, i, t, x, y = heapq.heappop(queue)
            j = after[i]
            if ids[i] != x or j >= n or ids[j] != y:
                continue
            ids[i], ids[j] = t, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (ids[a], ids[b]) in pairs:
                    rank, new = pairs[ids[a], ids[b]]
                    heapq.heappush(queue, (rank, a, new, ids[a], ids[b]))
        return [x for x in ids if x >= 0]

    def merge_short(self, s: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``merge`` of many words at once (their symbols one after another): in each step every
        word merges all places of its lowest pair.  Returns ids and their number by word."""
        ids, word = self.base[s], np.repeat(np.arange(len(size)), size)
        rank = np.full(len(ids), NEVER)
        made = np.zeros(len(ids), np.int64)

        def look_up(at):
            at = at[(at >= 0) & (at + 1 < len(ids))]
            at = at[word[at] == word[at + 1]]
            key = ids[at] * self.n + ids[at + 1]
            found = np.searchsorted(self.keys, key)
            hit = self.keys[found] == key
            rank[at] = np.where(hit, self.key_rank[found], NEVER)
            made[at[hit]] = self.key_token[found[hit]]

        look_up(np.arange(len(ids)))
        done = []
        while len(ids):
            first = np.flatnonzero(np.diff(word, prepend=-1))
            low = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(ids))))
            over = low == NEVER
            if over.any():
                done.append((word[over], ids[over]))
                ids, word, rank, made, low = (x[~over] for x in (ids, word, rank, made, low))
                if not len(ids):
                    break
            hit = np.flatnonzero(rank == low)
            run = np.flatnonzero(np.diff(hit, prepend=-2) != 1)  # overlapping places: every second one
            hit = hit[(np.arange(len(hit)) - np.repeat(run, np.diff(np.append(run, len(hit))))) % 2 == 0]
            ids[hit] = made[hit]
            rank[hit] = NEVER
            kept = np.ones(len(ids), bool)
            kept[hit + 1] = False
            at = (np.cumsum(kept) - 1)[hit]
            ids, word, rank, made = (x[kept] for x in (ids, word, rank, made))
            rank[at - (at > 0)] = np.where((at > 0) & (word[at - (at > 0)] == word[at]), NEVER, rank[at - (at > 0)])
            look_up(np.concatenate([at - 1, at]))
        if not done:
            return ids, size
        word, ids = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(word, kind="stable")
        return ids[order], np.bincount(word, minlength=len(size))

    def encode_words(self, raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """(ids, starts, lens, failed) of the words ``raw[ends[i - 1]:ends[i]]`` of bytes, none
        empty: word i has ``ids[starts[i]:starts[i] + lens[i]]``; the number of words that needed
        merging."""
        size = np.diff(ends, prepend=0)
        s = raw.astype(np.int64)
        s[ends - 1] += END
        ids, word = self.propose(s, ends - size, ends)
        lens = np.bincount(word, minlength=len(size))
        starts = np.cumsum(lens) - lens
        near = np.flatnonzero(word[1:] == word[:-1])
        wrong = near[~self.compatible(ids[near], ids[near + 1])]
        failed = np.unique(word[wrong])
        short = failed[size[failed] <= SHORT]
        own, n = self.merge_short(s[spans(ends[short] - size[short], size[short])], size[short])
        starts[short], lens[short] = len(ids) + np.cumsum(n) - n, n
        more, at = [ids, own], len(ids) + len(own)
        for w in failed[size[failed] > SHORT].tolist():
            own = self.merge(s[ends[w] - size[w]:ends[w]].tolist())
            more.append(np.array(own, np.int64))
            starts[w], lens[w] = at, len(own)
            at += len(own)
        return np.concatenate(more).astype(np.int32), starts, lens, len(failed)


class Codec:
    """A tokenizer file: words of texts, their ids, and texts of ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"]["pretokenizers"][0]
        kinds = [x["type"] for x in spec["normalizer"]["normalizers"]]
        if (kinds != ["NFC", "Replace", "Lowercase"] or split["pattern"].get("Regex") != WORD_PATTERN or spec["decoder"] or spec["post_processor"]
                or model["end_of_word_suffix"] != SUFFIX or model["ignore_merges"] or model["dropout"] or model["continuing_subword_prefix"]):
            raise ValueError(f"{path}: not a lower-case word BPE of the supported kind")
        if any(t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: special tokens are matched in the text as it is")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merges = Merges(model["vocab"], merges)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.tokenizer = Tokenizer.from_file(path)  # for the Unicode tables of its first two steps
        self.chars = byte_symbols()
        texts = {i: t for t, i in (model["vocab"] | self.special).items()}
        shown = [(texts.get(i, "") + " ").encode() for i in range(max(texts) + 1)]
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.shown_len = np.fromiter(map(len, shown), np.int64, len(shown))
        self.shown_at = np.cumsum(self.shown_len) - self.shown_len

    def words(self, pieces: list[str]) -> tuple[list[str], list[int]]:
        """Words of all pieces, a line end after those of each piece, and the numbers of the
        pieces in that order.  A special token is a word after a tab."""
        plain, latin, other = [], [], []
        for i, p in enumerate(pieces):
            if self.cut and "<" in p and self.cut.search(p):
                other.append(i)
            else:
                (plain if p.isascii() else latin if _LATIN.fullmatch(p) else other).append(i)
        out = []
        for some, pattern in ((plain, _PLAIN_WORDS), (latin, _LATIN_WORDS)):
            out += pattern.findall("".join([pieces[i].lower() + "\n" for i in some]))
        normal, split = self.tokenizer.normalizer.normalize_str, self.tokenizer.pre_tokenizer.pre_tokenize_str
        for i in other:
            for part in self.cut.split(pieces[i]) if self.cut else [pieces[i]]:
                if part in self.special:
                    out.append("\t" + part)
                else:
                    out += [bytes(map(self.chars.__getitem__, w)).decode() for w, _ in split(normal(part))]
            out.append("\n")
        return out, plain + latin + other

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of the distinct pieces; start and length in them of each piece of each text; number
        of pieces of each text).  A piece stands between ASCII white space, which no word and
        no composition crosses."""
        split = pc.ascii_split_whitespace(texts)
        count = pc.list_value_length(split).to_numpy().astype(np.int64)
        coded = split.flatten().dictionary_encode()
        words, order = self.words(coded.dictionary.to_pylist())
        words = pa.array(words, pa.string()).dictionary_encode()
        own, distinct = words.indices.to_numpy().astype(np.int64), words.dictionary
        if not len(own):
            return np.zeros(0, np.int32), np.zeros((2, 0), np.int64), count
        upto, raw = np.frombuffer(distinct.buffers()[1], np.int32)[:len(distinct) + 1], np.frombuffer(distinct.buffers()[2], np.uint8)
        ids, starts, lens, _ = self.merges.encode_words(raw[:upto[-1]], upto[1:].astype(np.int64))
        for text, i in self.special.items():
            at = pc.index(distinct, "\t" + text).as_py()
            if at >= 0:
                starts[at], lens[at] = len(ids), 1
                ids = np.append(ids, np.int32(i))
        stop = own == pc.index(distinct, "\n").as_py()
        piece = np.array(order, np.int64)[np.cumsum(stop) - stop]
        piece, own = piece[~stop], own[~stop]
        size = np.bincount(piece, lens[own], len(order)).astype(np.int64)
        ids = ids[spans(starts[own], lens[own])]  # of the pieces in the order of ``order``
        first = np.zeros(len(order), np.int64)
        first[order] = np.cumsum(size[order]) - size[order]
        flat = coded.indices.to_numpy()
        return ids, np.stack([first[flat], size[flat]]), count

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes and offsets of the texts of ``ids[offsets[i]:offsets[i + 1]]``."""
        out = [self.shown[spans(self.shown_at[x], self.shown_len[x])] for x in np.split(ids, range(BATCH_TOKENS, len(ids), BATCH_TOKENS))]
        raw = np.concatenate(out)
        upto = np.concatenate([[0], np.cumsum(self.shown_len[ids])])[offsets]
        ends = upto[1:][np.diff(upto) > 0] - 1  # the space after the last token of a text
        kept = np.ones(len(raw), bool)
        kept[ends] = False
        full = (np.diff(upto) > 0).astype(np.int64)
        return raw[kept], upto - np.concatenate([[0], np.cumsum(full)])


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The file, read once per worker process."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


CODEC_SCHEMA = "doc_id long, n_tokens long, ids array<int>, decoded string"


def _blocks(batches, block_chars: int):
    """Record batches of (id, text) cut and put together again at about ``block_chars`` bytes."""
    held, size = [], 0
    for rb in batches:
        upto, at = np.cumsum(pc.binary_length(rb.column(1)).to_numpy().astype(np.int64) + 64), 0
        while at < rb.num_rows:
            before = int(upto[at - 1]) if at else 0
            to = min(int(np.searchsorted(upto, before + block_chars - size)) + 1, rb.num_rows)
            held.append(rb.slice(at, to - at))
            size, at = size + int(upto[to - 1]) - before, to
            if size >= block_chars:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _code(path: str, block_chars: int):
    def run(batches):
        own = codec(path)
        for block in _blocks(batches, block_chars):
            docs = block.column(0).combine_chunks()
            ids, pieces, count = own.encode(block.column(1).combine_chunks())
            last = np.cumsum(count)
            upto = np.concatenate([[0], np.cumsum(pieces[1])])
            size = upto[last] - upto[last - count]
            cuts, held = [0], 0
            for i, n in enumerate(size.tolist()):
                held += n
                if held > BATCH_TOKENS:
                    cuts, held = cuts + [i + 1], 0
            for a, b in zip(cuts, cuts[1:] + [len(docs)]):
                if a == b:
                    continue
                part = slice(last[a] - count[a], last[b - 1])
                mine = ids[spans(pieces[0, part], pieces[1, part])]
                offsets = np.concatenate([[0], np.cumsum(size[a:b])])
                raw, ends = own.decode(mine, offsets)
                yield pa.RecordBatch.from_arrays(
                    [docs[a:b], pa.array(size[a:b]),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(mine, pa.int32())),
                     pa.StringArray.from_buffers(b - a, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(raw))],
                    names=["doc_id", "n_tokens", "ids", "decoded"])

    return run


def encode_decode(docs: DataFrame, path: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): ids without special tokens around them,
    their number, and the decoded text.  ``path`` is the tokenizer file on every worker."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_code(path, block_chars), CODEC_SCHEMA)


def op13_query(docs: DataFrame, path: str) -> DataFrame:
    return encode_decode(docs, path).select(
        "doc_id", "n_tokens", F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
