"""Token ids as shards of Re-Pair grammars.

Texts are encoded in ascending order of doc_id and written as shards. A shard holds
the ids of consecutive documents, compressed by a grammar: in each round the frequent
pairs of neighbouring symbols become nonterminals, the more frequent first where
pairs overlap. Rules are stored with their expansion lengths, and each document with
its numbers of symbols and of ids, so one document is decoded without the others.
Pairs never span two documents.

Files: one Parquet row per shard with the columns of SHARD; integer sections are
little-endian. They are written by Spark's own writer, so any store works, a lost
task is retried as a whole, and only complete shards are seen.

Defined cases: NULL is the empty text and holds only the end id; a NULL id comes
first; rows that repeat an id are neighbours; no documents give no shard.
"""

from __future__ import annotations

import os
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import work_folder
from .shared import Words, distinct, small_side, text_runs

VOCABULARY = "word_bpe_49k.json"
END = 1
SHARD_IDS = 1 << 19
ROUNDS, LEAST, RULES = 3, 16, 5000
CACHE_WORDS = 2_500_000

SHARD = (
    "task long, part long, n_docs long, n_ids long, low_id long, high_id long, first_rule long, "
    "doc_ids binary, doc_known binary, doc_symbols binary, doc_lengths binary, rules binary, rule_lengths binary, symbols binary"
)


# Bytes by what the tokenizer makes of them: letters, digits, other printable ASCII, and all that is not told by a byte.
OPEN, LETTER, DIGIT, SIGN = range(4)
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[33:127] = SIGN
_KIND[48:58] = DIGIT
_KIND[65:91] = _KIND[97:123] = LETTER
_KIND[39] = OPEN  # an apostrophe may belong to the letters after it


def kinds(data: np.ndarray) -> np.ndarray:
    """Kind of each byte; a letter of two bytes from U+00C0 to U+00FF is a LETTER too."""
    kind = _KIND[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    kind[lead] = kind[lead + 1] = LETTER
    return kind


def cuts(data: np.ndarray) -> np.ndarray:
    """Where the tokenizer splits a word whatever stands around: between letters, signs and each digit."""
    kind = kinds(data)
    cut = np.zeros(len(data), dtype=bool)
    cut[1:] = ((kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)) & (kind[1:] != OPEN) & (kind[:-1] != OPEN)
    return cut


class WordEncoder:
    """Encodes parts of words, each distinct one once. The tokenizer drops blanks, splits words at
    ``cuts`` and merges nothing across them, so the ids of a text are those of its parts in order."""

    def __init__(self, name: str = VOCABULARY):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(name if os.path.sep in name else public_tokenizers.path(name))
        self.size = self.tokenizer.get_vocab_size()
        self.ends = np.zeros(self.size, dtype=bool)  # ids that end what the tokenizer splits off
        self.ends[[i for word, i in self.tokenizer.get_vocab().items() if word.endswith("</w>")]] = True
        self._forget()

    def _forget(self):
        self.keys = np.zeros(0, dtype=np.uint64)  # hashes of known parts, ascending
        self.slot = np.zeros(0, dtype=np.int64)  # their places in starts
        self.starts, self.flat = np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint16)

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the parts and how many each has. Parts of one kind of byte are encoded some hundred at once,
        as each ends with the first id that ends anything; the others one by one."""
        size = ends - starts
        first = np.cumsum(size + 1) - size - 1
        joined = np.full(int((size + 1).sum()), 32, dtype=np.uint8)
        joined[ragged(first, size)] = data[ragged(starts, size)]
        told = np.minimum.reduceat(np.where(joined == 32, SIGN, kinds(joined)), first) > OPEN
        raw, ids, lengths = joined.tobytes(), [], np.zeros(len(size), dtype=np.int64)
        edges = np.unique(np.concatenate([np.flatnonzero(np.diff(told)) + 1, np.arange(0, len(size), 500), [len(size)]])).tolist()
        encode = self.tokenizer.encode_batch_fast
        for lo, hi in zip(edges[:-1], edges[1:]):
            text = raw[first[lo] : first[hi - 1] + size[hi - 1]].decode()
            if told[lo]:
                got = np.asarray(encode([text], add_special_tokens=False)[0].ids, dtype=np.uint16)
                last = np.flatnonzero(self.ends[got])
                if len(last) == hi - lo and last[-1] == len(got) - 1:
                    ids.append(got)
                    lengths[lo:hi] = np.diff(last, prepend=-1)
                    continue
            lists = [one.ids for one in encode(text.split(" "), add_special_tokens=False)]
            lengths[lo:hi] = [len(x) for x in lists]
            ids.append(np.fromiter(chain.from_iterable(lists), dtype=np.uint16, count=int(lengths[lo:hi].sum())))
        return np.concatenate(ids), lengths

    def _direct(self, text: str) -> np.ndarray:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint16)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and how many each has."""
        ids, lengths = self._by_parts(data, offsets)
        raw = data.tobytes()
        if b"<|" not in raw:
            return ids, lengths
        # Names of special tokens are told by case and may span blanks: a text with one is encoded whole.
        parts, at, ends = [], 0, np.cumsum(lengths)
        for k, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            if b"<|" in raw[a:b]:
                own = self._direct(raw[a:b].decode())
                parts += [ids[at : ends[k] - lengths[k]], own]
                at, lengths[k] = ends[k], len(own)
        return np.concatenate([*parts, ids[at:]]), lengths

    def _by_parts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = Words(data, offsets, cut=cuts)
        hashes, example, place = distinct(found.hashes)
        if len(self.keys) > CACHE_WORDS:
            self._forget()
        where = np.searchsorted(self.keys, hashes)
        new = np.flatnonzero(self.keys[np.minimum(where, len(self.keys) - 1)] != hashes) if len(self.keys) else np.arange(len(hashes))
        if len(new):
            flat, lengths = self._learn(data, found.starts[example[new]], found.ends[example[new]])
            where = where[new]
            self.slot = np.insert(self.slot, where, len(self.keys) + np.arange(len(new)))
            self.keys = np.insert(self.keys, where, hashes[new])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])
            self.flat = np.concatenate([self.flat, flat])
            where = np.searchsorted(self.keys, hashes)
        index = self.slot[where][place]
        lengths = self.starts[index + 1] - self.starts[index]
        ids = self.flat[ragged(self.starts[index], lengths)]
        total = np.concatenate([[0], np.cumsum(lengths)])
        return ids, np.diff(total[found.first])


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (lengths[0] of them), starts[1], ..."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def compress(ids: np.ndarray, lengths: np.ndarray, first_rule: int, rounds: int = ROUNDS, least: int = LEAST, most: int = RULES):
    """(rules, symbols, symbols per document) of a Re-Pair grammar, ``most`` new rules a round at most."""
    seq = ids.astype(np.uint32)
    full = lengths > 0
    last = np.zeros(len(seq), dtype=bool)
    last[np.cumsum(lengths)[full] - 1] = True
    rules: list[np.ndarray] = []
    base = first_rule
    for _ in range(rounds):
        if len(seq) < 2:
            break
        left, right = seq[:-1], seq[1:]
        slot = (left * np.uint32(0x9E3779B1) + right * np.uint32(0x85EBCA77)) >> np.uint32(12)
        slot[last[:-1]] = 1 << 20  # pairs never span documents
        slot = slot.astype(np.int64)
        count = np.bincount(slot, minlength=(1 << 20) + 1)[:-1]
        hot = np.flatnonzero(count >= least)  # a frequent pair makes its slot frequent
        above = np.cumsum(np.bincount(np.minimum(count[hot], 4096), minlength=1)[::-1])  # slots with so many or more
        hot = hot[count[hot] >= max(least, len(above) - 1 - int(np.searchsorted(above, most)))]
        number = np.full((1 << 20) + 1, -1, dtype=np.int16 if len(hot) < 1 << 15 else np.int32)
        number[hot] = np.arange(len(hot))
        mine = number[slot]
        at = np.flatnonzero(mine >= 0)
        mine, pairs = mine[at].astype(np.int64), left[at].astype(np.int64) << 32 | right[at]
        pair = np.zeros(len(hot), dtype=np.int64)
        pair[mine] = pairs  # one pair speaks for a slot, others wait for the next round
        same = pairs == pair[mine]
        at, mine = at[same], mine[same]
        count = np.bincount(mine, minlength=len(hot))
        order = np.argsort(-count, kind="stable")
        order = order[: min(most, int((count >= least).sum()))]
        if not len(order):
            break
        rank = np.zeros(len(hot), dtype=np.int32)
        rank[order] = np.arange(len(order), 0, -1)
        mine = rank[mine]  # rank of the pair that begins there; 0: none
        ranked = mine > 0
        take, chosen = _chosen(at[ranked], mine[ranked])
        rules.append(pair[order])
        seq = seq.copy()
        seq[take] = base + len(order) - chosen
        base += len(order)
        stay = np.ones(len(seq), dtype=bool)
        stay[take + 1] = False
        last[take] |= last[take + 1]
        seq, last = seq[stay], last[stay]
    counts = np.zeros(len(lengths), dtype=np.int64)
    counts[full] = np.diff(np.concatenate([[0], np.flatnonzero(last) + 1]))
    packed = np.concatenate(rules) if rules else np.zeros(0, dtype=np.int64)
    return np.stack([packed >> 32, packed & 0xFFFFFFFF], axis=1), seq, counts


def _chosen(at: np.ndarray, rank: np.ndarray, passes: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Places (of the ascending ones that pairs begin at, with their ranks) of pairs that do not overlap, and their ranks:
    those ranked above both neighbours, every other one in a run of the same pair; then again among the places that are left."""
    whole, ranks, left = at, rank, np.arange(len(at))
    taken = [left[:0]]
    for _ in range(passes):
        touch = at[1:] == at[:-1] + 1
        up, down = rank[1:] >= rank[:-1], rank[1:] <= rank[:-1]
        pick = np.ones(len(at), dtype=bool)
        pick[1:] &= up | ~touch
        pick[:-1] &= down | ~touch
        tied = np.flatnonzero(touch & up & down) + 1  # places of the same pair as the place before
        if len(tied):
            begin = np.arange(len(at))
            begin[tied] = 0
            begin = np.maximum.accumulate(begin)
            pick[tied] &= (tied - begin[tied]) % 2 == 0
        if not pick.any():
            break
        taken.append(left[pick])
        stay = ~pick
        stay[1:] &= ~(pick[:-1] & touch)
        stay[:-1] &= ~(pick[1:] & touch)
        left, at, rank = left[stay], at[stay], rank[stay]
    found = np.sort(np.concatenate(taken))
    return whole[found], ranks[found]


def expansions(rules: np.ndarray, lengths: np.ndarray, first_rule: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each rule's ids begin, and all ids of the rules: a rule only uses rules of earlier rounds."""
    starts = np.cumsum(lengths) - lengths
    flat = np.zeros(int(lengths.sum()), dtype=np.int64)
    for side in (0, 1):
        part = rules[:, side]
        plain = part < first_rule
        at = starts + (lengths - _lengths(part, lengths, first_rule) if side else 0)
        flat[at[plain]] = part[plain]
    for k in np.flatnonzero((rules >= first_rule).any(axis=1)).tolist():
        at = starts[k]
        for symbol in rules[k].tolist():
            if symbol < first_rule:
                at += 1
            else:
                r = symbol - first_rule
                flat[at : at + lengths[r]] = flat[starts[r] : starts[r] + lengths[r]]
                at += lengths[r]
    return starts, flat


def _lengths(symbols: np.ndarray, rule_lengths: np.ndarray, first_rule: int) -> np.ndarray:
    out = np.ones(len(symbols), dtype=np.int64)
    nonterminal = symbols >= first_rule
    out[nonterminal] = rule_lengths[symbols[nonterminal] - first_rule]
    return out


def rule_lengths(rules: np.ndarray, first_rule: int) -> np.ndarray:
    out = np.zeros(len(rules), dtype=np.int64)
    for k, (a, b) in enumerate(rules.tolist()):
        out[k] = (1 if a < first_rule else out[a - first_rule]) + (1 if b < first_rule else out[b - first_rule])
    return out


def decode(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, first_rule: int) -> np.ndarray:
    starts, flat = expansions(rules, lengths, first_rule)
    table = np.concatenate([np.arange(first_rule), flat])
    nonterminal = symbols >= first_rule
    begin = symbols.astype(np.int64)
    begin[nonterminal] = starts[symbols[nonterminal] - first_rule] + first_rule
    return table[ragged(begin, _lengths(symbols, lengths, first_rule))]


_encoders: dict[str, WordEncoder] = {}


def _shards(vocabulary: str):
    def run(batches):
        if vocabulary not in _encoders:
            _encoders[vocabulary] = WordEncoder(vocabulary)
        encoder = _encoders[vocabulary]
        task, part = TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, np.ndarray, list]] = []
        n = 0
        for batch in batches:
            for lo, hi, data, offsets in text_runs(batch.column("text")):
                ids, lengths = encoder.encode(data, offsets)
                first = np.concatenate([[0], np.cumsum(lengths)])
                ended = np.full(len(ids) + len(lengths), END, dtype=np.uint16)
                ended[ragged(first[:-1] + np.arange(len(lengths)), lengths)] = ids
                held.append((ended, lengths + 1, batch.column("doc_id").slice(lo, hi - lo).to_pylist()))
                n += len(ended)
                if n >= SHARD_IDS:
                    yield _shard(task, part, held, encoder.size)
                    held, n, part = [], 0, part + 1
        if held:
            yield _shard(task, part, held, encoder.size)

    return run


def _shard(task, part, held, first_rule) -> pa.RecordBatch:
    ids = np.concatenate([x[0] for x in held])
    lengths = np.concatenate([x[1] for x in held])
    docs = [d for x in held for d in x[2]]
    rules, symbols, counts = compress(ids, lengths, first_rule)
    known = np.array([d is not None for d in docs], dtype=np.uint8)
    here = [d for d in docs if d is not None]
    u4 = lambda x: np.ascontiguousarray(x, dtype="<u4").tobytes()
    row = {
        "task": task, "part": part, "n_docs": len(docs), "n_ids": len(ids),
        "low_id": min(here, default=None), "high_id": max(here, default=None), "first_rule": first_rule,
        "doc_ids": np.array([d or 0 for d in docs], dtype="<i8").tobytes(), "doc_known": known.tobytes(),
        "doc_symbols": u4(counts), "doc_lengths": u4(lengths), "rules": u4(rules),
        "rule_lengths": u4(rule_lengths(rules, first_rule)),
        "symbols": np.ascontiguousarray(symbols, dtype="<u2" if first_rule + len(rules) <= 1 << 16 else "<u4").tobytes(),
    }
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    fields = [field.split() for field in SHARD.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([row[n]], kinds[k]) for n, k in fields], names=[n for n, _ in fields])


def write_shards(docs: DataFrame, path: str, vocabulary: str = VOCABULARY) -> None:
    """Shards in ascending order of doc_id. The order is a range shuffle with the text's
    hash as tie-break, so also a run of equal ids is split."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    tie = F.xxhash64("text")
    ranged = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), tie).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie)
    ranged.mapInArrow(_shards(vocabulary), SHARD).write.mode("overwrite").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHARD).parquet(path)


def _sections(batch: pa.RecordBatch, k: int):
    get = lambda name: batch.column(name)[k].as_py()
    u4 = lambda name: np.frombuffer(get(name), dtype="<u4").astype(np.int64)
    first_rule = get("first_rule")
    rules, lengths = u4("rules").reshape(-1, 2), u4("rule_lengths")
    wide = first_rule + len(rules) > 1 << 16
    symbols = np.frombuffer(get("symbols"), dtype="<u4" if wide else "<u2").astype(np.int64)
    ids = np.frombuffer(get("doc_ids"), dtype="<i8")
    known = np.frombuffer(get("doc_known"), dtype=np.uint8).astype(bool)
    return first_rule, rules, lengths, symbols, ids, known, u4("doc_symbols"), u4("doc_lengths")


def _documents(batches):
    """Digests of each document, from a decoded shard."""
    for batch in batches:
        for k in range(batch.num_rows):
            first_rule, rules, lengths, symbols, ids, known, _, doc_lengths = _sections(batch, k)
            flat = decode(symbols, rules, lengths, first_rule).astype("<u4")
            ends = np.cumsum(doc_lengths)
            crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip((ends - doc_lengths).tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, mask=~known),
                    pa.array(batch.column("start")[k].as_py() + ends - doc_lengths),
                    pa.array(doc_lengths),
                    pa.array(crc, pa.int64()),
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, decoded from the files.

    The running count of ids goes over one narrow row per shard, not over the shards.
    """
    shards = read_shards(spark, path)
    before = W.orderBy("task", "part").rowsBetween(W.unboundedPreceding, -1)
    starts = shards.select("task", "part", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start"))
    placed = shards.join(small_side(starts), ["task", "part"])
    return placed.mapInArrow(_documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _one(wanted: int):
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                first_rule, rules, lengths, symbols, ids, known, doc_symbols, _ = _sections(batch, k)
                ends = np.cumsum(doc_symbols)
                for d in np.flatnonzero((ids == wanted) & known):
                    own = symbols[ends[d] - doc_symbols[d] : ends[d]]
                    yield pa.RecordBatch.from_pydict({"doc_id": [wanted], "ids": [decode(own, rules, lengths, first_rule).tolist()]})

    return run


def document(spark: SparkSession, path: str, doc_id: int) -> DataFrame:
    """doc_id and ids (with the end id) of one document: only shards whose range holds it
    are read, and of those only its symbols are expanded."""
    near = read_shards(spark, path).where(F.lit(doc_id).between(F.col("low_id"), F.col("high_id")))
    return near.mapInArrow(_one(doc_id), "doc_id long, ids array<long>")


def op10(spark: SparkSession, docs: DataFrame) -> DataFrame:
    path = work_folder(spark, "token-shards")
    write_shards(docs, path)
    return documents(spark, path)
