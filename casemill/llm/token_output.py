"""Token ids in binary shards, compressed by a Re-Pair grammar with random access."""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm import files, words
from casemill.llm.shared import materialize, n_partitions, new_path, running

#: Appended to each document.
END = 2
#: A shard is closed once it holds this many ids; it never splits a document. Compressing takes about 80 bytes of memory for each id.
SHARD_IDS = 1_000_000
#: Words whose ids a Python worker keeps at one time (about 260 bytes each).
CACHED = 300_000
#: A pair that occurs so often, without overlapping itself, becomes a rule.
LEAST = 2
MAGIC = b"GRAMMAR2"


#: How a tokenizer changes and splits texts that may be encoded word by word.
KIND = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "model": "BPE",
}
NEVER = np.iinfo(np.int32).max
#: Numbers that are made at one time, to need less memory.
BLOCK = 1 << 18


def _grouped(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different keys (of that many bits), the places of all keys in their order, and how often each key occurs. keys is overwritten."""
    low = max(1, len(keys).bit_length())
    if bits + low < 64:  # keys and places fit into one number, which sorts faster than places by keys
        keys <<= low
        for a in range(0, len(keys), BLOCK):
            keys[a : a + BLOCK] |= np.arange(a, min(a + BLOCK, len(keys)))
        keys.sort()
        order = np.empty(len(keys), np.int32)
        np.bitwise_and(keys, (1 << low) - 1, out=order, casting="unsafe")
        keys >>= low
    else:
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
    new = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    starts = np.flatnonzero(new)
    return keys[starts], order, np.diff(np.append(starts, len(keys)))


def _most_first(counts: np.ndarray) -> np.ndarray:
    """Places of counts in descending order, equal ones as they stand: by 16 bits at a time, which numpy sorts in one pass each."""
    below = (counts.max() - counts).astype(np.uint32)
    order = np.argsort(below.astype(np.uint16), kind="stable")
    return order if below.max(initial=0) < 1 << 16 else order[np.argsort((below >> np.uint32(16)).astype(np.uint16)[order], kind="stable")]


def compress(ids: np.ndarray, doc_ends: np.ndarray, first_symbol: int, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair: symbols, the places where documents end in them, and rules (left, right) from first_symbol on.

    Goes on until no pair within a document occurs `least` times. A round ranks all pairs by their numbers and replaces
    each occurrence that no overlapping one outranks, so the most frequent pair is replaced wherever it is; pairs
    that lose more than half of their occurrences to others wait. Of a run of equal symbols every other pair counts. Symbols are linked,
    and a later round looks only at pairs that were frequent enough and at the neighbours of new symbols.
    """
    n, kind = len(ids), np.int32
    symbol = np.zeros(n + 1, kind)
    symbol[:n] = ids
    after, before = np.arange(1, n + 2, dtype=kind), np.arange(-1, n, dtype=kind)  # place n is behind the last one, and before the first
    last, alive, rank = np.zeros(n + 1, bool), np.ones(n + 1, bool), np.full(n + 2, NEVER, kind)
    last[doc_ends - 1] = last[n] = True
    alive[n] = False
    rules, total = [np.zeros((0, 2), np.int64)], first_symbol
    pairs = np.flatnonzero(~last).astype(kind)
    while len(pairs):
        left, right, use, odd = symbol[pairs], symbol[after[pairs]], pairs, pairs[:0]
        if len(same := np.flatnonzero(left == right)):
            runs = pairs[same]
            heads = np.flatnonzero(np.concatenate([[True], after[runs[:-1]] != runs[1:]]))
            second = (np.arange(len(runs)) - np.repeat(heads, np.diff(np.append(heads, len(runs))))) % 2 == 1
            counted = np.ones(len(pairs), bool)
            counted[same[second]] = False
            use, left, right, odd = pairs[counted], left[counted], right[counted], runs[second]
        bits = int(total).bit_length()
        both = left.astype(np.int64)
        both <<= bits
        both |= right
        del left, right
        keys, order, counts = _grouped(both, 2 * bits)
        del both
        often = counts >= least
        if not often.any():
            break
        if not often.all():
            order, keys, counts = order[np.repeat(often, counts)], keys[often], counts[often]
        by_place, place = _most_first(counts), np.empty(len(keys), kind)
        place[by_place] = np.arange(len(keys), dtype=kind)
        mine = np.full(len(use), NEVER, kind)
        mine[order] = np.repeat(place, counts)
        del order
        rank[use] = mine
        ranked = mine < NEVER
        at, mine = use[ranked], mine[ranked]
        chosen = mine < rank[before[at]]
        chosen &= mine < rank[after[at]]
        rank[at] = NEVER
        here, mine = at[chosen], mine[chosen]
        got = np.bincount(mine, minlength=len(keys))
        new = (got >= least) & (2 * got >= counts[by_place])
        here, mine = here[new[mine]], mine[new[mine]]
        keys = keys[by_place][new]
        rules.append(np.stack([keys >> bits, keys & ((1 << bits) - 1)], 1))
        gone = after[here]
        symbol[here] = (total - 1 + np.cumsum(new))[mine]
        total += int(new.sum())
        last[here], alive[gone] = last[gone], False
        after[here] = after[gone]
        before[after[here]] = here
        still = np.zeros(n + 1, bool)
        for places in (at, odd, here, before[here]):
            still[places] = True
        pairs = np.flatnonzero(still & alive & ~last).astype(kind)
    return symbol[alive].astype(np.int64), np.flatnonzero(last[alive]) + 1, np.concatenate(rules)


def expand(seq: np.ndarray, rules: np.ndarray, first_symbol: int) -> np.ndarray:
    """The ids that symbols stand for: all rules at once, as often as they are nested."""
    seq = seq.astype(np.int64)
    while len(rules) and (high := seq >= first_symbol).any():
        at = np.cumsum(1 + high) - 1 - high
        out = np.empty(len(seq) + int(high.sum()), np.int64)
        rule = rules[seq[high] - first_symbol]
        out[at[~high]] = seq[~high]
        out[at[high]], out[at[high] + 1] = rule[:, 0], rule[:, 1]
        seq = out
    return seq


def rule_lengths(rules: np.ndarray, first_symbol: int) -> np.ndarray:
    """How many ids each rule stands for; a rule's sides come before it."""
    out = np.zeros(len(rules), np.int64)
    sides = rules - first_symbol
    todo = np.arange(len(rules))
    while len(todo):
        sizes = np.where(sides[todo] < 0, 1, out[np.maximum(sides[todo], 0)])
        ready = (sizes > 0).all(1)
        out[todo[ready]] = sizes[ready].sum(1)
        todo = todo[~ready]
    return out


def in_bits(numbers: np.ndarray, width: int) -> bytes:
    """Numbers below 2**width, each in so many bits."""
    return np.packbits(np.unpackbits(numbers.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width], bitorder="little").tobytes()


def from_bits(data: bytes, width: int, begin: int, end: int) -> np.ndarray:
    """The numbers from `begin` to `end` of those that in_bits() gave: each is within the 8 bytes from its first one on."""
    if begin >= end:
        return np.zeros(0, np.int64)
    at = np.arange(begin, end, dtype=np.int64) * width
    first = int(at[0] >> 3)
    held = np.zeros(int(at[-1] >> 3) - first + 8, np.uint8)
    there = np.frombuffer(data, np.uint8)[first : first + len(held)]
    held[: len(there)] = there
    windows = np.ndarray((len(held) - 7,), "<u8", held, 0, (1,))
    return ((windows[(at >> 3) - first] >> (at & 7).astype(np.uint64)) & np.uint64((1 << width) - 1)).astype(np.int64)


def expansions(rules: np.ndarray, lengths: np.ndarray, first_symbol: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids in a row, first all ids themselves, then what each rule stands for; and where those of each rule begin. A rule is copied from its sides, once both are there."""
    begins = first_symbol + np.cumsum(lengths) - lengths
    pool = np.empty(first_symbol + int(lengths.sum()), np.int32)
    pool[:first_symbol] = np.arange(first_symbol)
    plain, inner = rules < first_symbol, np.maximum(rules - first_symbol, 0)
    start, size = np.where(plain, rules, begins[inner]), np.where(plain, 1, lengths[inner])
    done, todo = np.zeros(len(rules), bool), np.arange(len(rules))
    while len(todo):
        ready = (plain[todo] | done[inner[todo]]).all(1)
        now, todo = todo[ready], todo[~ready]
        pool[_runs(begins[now], lengths[now])] = pool[_runs(start[now].reshape(-1), size[now].reshape(-1))]
        done[now] = True
    return pool, begins


def pack(doc_ids: list[int | None], ids: np.ndarray, doc_ends: np.ndarray, vocabulary: int) -> bytes:
    """A shard: magic, length of the head, head (JSON), arrays, CRC-32 of all that.

    Arrays: document ids and whether they are null, ends of documents in symbols and in ids, the number of ids that each
    rule stands for; rules and symbols, each number in as few bits as the largest symbol needs.
    """
    seq, ends, rules = compress(ids, doc_ends, vocabulary)
    width = max(1, int(vocabulary + len(rules) - 1).bit_length())
    parts = [
        np.array([x or 0 for x in doc_ids], "<i8").tobytes(), np.array([x is None for x in doc_ids], "<u1").tobytes(), ends.astype("<i8").tobytes(), doc_ends.astype("<i8").tobytes(),
        rule_lengths(rules, vocabulary).astype("<u4").tobytes(), in_bits(rules.reshape(-1), width), in_bits(seq, width),
    ]
    head = json.dumps({"vocabulary": vocabulary, "docs": len(doc_ids), "rules": len(rules), "symbols": len(seq), "ids": len(ids), "bits": width}).encode()
    body = MAGIC + struct.pack("<I", len(head)) + head + b"".join(parts)
    return body + struct.pack("<I", zlib.crc32(body))


class Shard:
    """A shard of pack() that decodes all of it, one document, or some of a document's ids."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC or zlib.crc32(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
            raise ValueError("not a whole shard")
        n = struct.unpack_from("<I", data, 8)[0]
        self.head, at = json.loads(data[12 : 12 + n]), 12 + n
        h = self.head

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, count, at)
            at += out.nbytes
            return out

        self.doc_ids, self.null = take("<i8", h["docs"]), take("<u1", h["docs"])
        self.symbol_ends, self.id_ends = take("<i8", h["docs"]), take("<i8", h["docs"])
        self.lengths = take("<u4", h["rules"]).astype(np.int64)
        self.rules = from_bits(take("<u1", -(-2 * h["rules"] * h["bits"] // 8)), h["bits"], 0, 2 * h["rules"]).reshape(-1, 2)
        self.symbols = take("<u1", -(-h["symbols"] * h["bits"] // 8))

    def _symbols(self, k: int) -> np.ndarray:
        return from_bits(self.symbols, self.head["bits"], int(self.symbol_ends[k - 1]) if k else 0, int(self.symbol_ends[k]))

    def all_ids(self) -> np.ndarray:
        """All ids: each rule is expanded once, unless rules nest so deeply that this takes more room than the ids."""
        seq, first = from_bits(self.symbols, self.head["bits"], 0, self.head["symbols"]), self.head["vocabulary"]
        if not len(self.rules) or int(self.lengths.sum()) > 4 * self.head["ids"]:
            return expand(seq, self.rules, first)
        pool, begins = expansions(self.rules, self.lengths, first)
        high = seq >= first
        start, size = seq.copy(), np.ones(len(seq), np.int64)
        start[high], size[high] = begins[seq[high] - first], self.lengths[seq[high] - first]
        return pool[_runs(start, size)].astype(np.int64)

    def document(self, k: int) -> np.ndarray:
        return expand(self._symbols(k), self.rules, self.head["vocabulary"])

    def some(self, k: int, begin: int, end: int) -> np.ndarray:
        """Ids begin to end of a document; only the symbols that cover them are expanded."""
        part = self._symbols(k)
        size = np.ones(len(part), np.int64)
        high = part >= self.head["vocabulary"]
        size[high] = self.lengths[part[high] - self.head["vocabulary"]]
        ends = np.cumsum(size)
        a, b = np.searchsorted(ends, begin, side="right"), np.searchsorted(ends, end) + 1
        skip = begin - (ends[a - 1] if a else 0)
        return expand(part[a:b], self.rules, self.head["vocabulary"])[skip : skip + end - begin]


class Encoder:
    """Encodes texts word by word, each different word once.

    The tokenizer drops white space and never joins across it, so this gives the ids of whole texts. A word
    of plain letters goes to the tokenizer's model directly. Marks behind such a word are taken as a word of their own, as
    the tokenizer splits there too. All other words go through the whole tokenizer.
    """

    #: Plain letters, then marks but no apostrophe, before which the tokenizer may not split.
    PARTS = r"^(?P<core>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<tail>[!-&(-/:-@\[-`{-~]*)$"

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.refuse_other_kinds(json.loads(self.tokenizer.to_str()))
        self.vocabulary = self.tokenizer.get_vocab_size()
        # Byte-level models spell each byte as a character: printable ones as themselves, the others from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.spelt = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in shown)}
        self.forget()

    @staticmethod
    def refuse_other_kinds(made: dict) -> None:
        """Raises an error for a tokenizer that may not be taken word by word as PARTS does: other normalisers, other ways to split, or another model."""
        found = {"normalizer": made.get("normalizer"), "pre_tokenizer": made.get("pre_tokenizer"), "model": made["model"]["type"]}
        if found != KIND:
            raise ValueError(f"its ids can't be found word by word: {found}")

    def forget(self) -> None:
        #: Known words, in the order of their places in the table of ids.
        self.places: dict[str, int] = {}
        self.flat, self.starts, self.met = np.empty(0, np.int32), np.zeros(1, np.int32), np.empty(0, np.int32)

    def learn(self, missing: list[str], plain: list[bool]) -> None:
        model, whole, spelt = self.tokenizer.model.tokenize, self.tokenizer.encode, self.spelt
        found = [
            [t.id for t in model(w if w.isascii() else w.encode().decode("latin-1").translate(spelt))] if p else whole(w, add_special_tokens=False).ids
            for w, p in zip(missing, plain, strict=True)
        ]
        ends = np.cumsum(np.fromiter(map(len, found), np.int32, len(found)), dtype=np.int32)
        self.places.update(zip(missing, range(len(self.places), len(self.places) + len(missing)), strict=True))
        self.starts = np.concatenate([self.starts, len(self.flat) + ends])
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(found), np.int32, int(ends[-1]))])
        self.met = np.concatenate([self.met, np.zeros(len(missing), np.int32)])

    def shrink(self) -> None:
        """Keeps the words that most slices met, CACHED / 2 at most."""
        kept = np.sort(np.argsort(-self.met, kind="stable")[: CACHED // 2])
        kept = kept[self.met[kept] > 1]
        names, ids = list(self.places), self.ids().take(pa.array(kept))
        self.places = {names[k]: place for place, k in enumerate(kept.tolist())}
        self.flat, self.starts, self.met = ids.flatten().to_numpy(), ids.offsets.to_numpy(), self.met[kept] // 2

    def ids(self) -> pa.ListArray:
        """The ids of all known words."""
        return pa.ListArray.from_arrays(pa.array(self.starts), pa.array(self.flat))

    def look_up(self, different: pa.Array, plain: np.ndarray) -> np.ndarray:
        """Places in the table of known words, to which new ones are added."""
        found = words.strings(different)
        at = np.fromiter(map(self.places.get, found, repeat(-1)), np.int64, len(found))
        if len(new := np.flatnonzero(at < 0)):
            at[new] = np.arange(len(self.places), len(self.places) + len(new))
            self.learn([found[k] for k in new.tolist()], plain[new].tolist())
        self.met[at] += 1
        return at

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's begin."""
        if len(self.places) > CACHED:
            self.shrink()
        begins, codes, different = words.split(texts, lower=False)
        parts = pc.extract_regex(different, self.PARTS)
        plain = pc.is_valid(parts)
        cores = pc.if_else(plain, pc.utf8_lower(pc.struct_field(parts, "core")), different).dictionary_encode()
        tails = pc.if_else(plain, pc.struct_field(parts, "tail"), "").dictionary_encode()
        numpy = lambda x: x.to_numpy(zero_copy_only=False)
        of_core = np.zeros(len(cores.dictionary), bool)
        of_core[numpy(cores.indices)] = numpy(plain)
        at = self.look_up(cores.dictionary, of_core)[numpy(cores.indices)]
        behind = self.look_up(tails.dictionary, np.zeros(len(tails.dictionary), bool))[numpy(tails.indices)]
        # Words and what is behind them, one after the other: each text's ids follow from those of its words.
        both = pa.array(np.stack([at, behind], 1).reshape(-1))
        each = self.ids().take(both)
        each = pa.ListArray.from_arrays(pa.array(each.offsets.to_numpy()[::2]), each.flatten())
        whole = each.take(pa.array(codes))
        return whole.flatten().to_numpy(), whole.offsets.to_numpy()[begins]


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... up to its size, then those of the next."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def write_shards(docs: DataFrame, tokenizer_path: str, folder: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encodes every text and writes shards in ascending order of ids; returns one row for each shard.

    Columns: part_no, shard_no (their order is that of the ids), path, n_docs, n_ids, start (ids in all
    earlier shards). Rows are range-partitioned by id, so each task writes its own run of documents.
    A null text counts as empty: it has the end id only. A very long text is encoded whole, and is one document of one shard. Null ids come first. Rows with one id follow each
    other, by the hash of their text. An empty table has no shards. Other columns aren't read. A task
    that runs twice writes files of other names; only those of the attempt that Spark accepts are listed.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part = words.per_worker(f"encoder {tokenizer_path}", lambda: Encoder(tokenizer_path)), TaskContext.get().partitionId()
        held: list[tuple[list, np.ndarray, np.ndarray]] = []
        shard = n_held = 0

        def flush() -> pa.RecordBatch:
            nonlocal shard, n_held
            doc_ids = list(chain.from_iterable(x[0] for x in held))
            ids, sizes = np.concatenate([x[1] for x in held]), np.concatenate([x[2] for x in held])
            held.clear()
            n_held = 0
            words.give_back()  # what the last slice took, before compressing takes its own
            with files.open_at(path := files.fresh(folder, ".ids"), "w") as f:
                f.write(pack(doc_ids, ids, np.cumsum(sizes), encoder.vocabulary))
            words.give_back()
            shard += 1
            return pa.RecordBatch.from_pylist([{"part_no": part, "shard_no": shard - 1, "path": path, "n_docs": len(doc_ids), "n_ids": len(ids)}], schema=schema)

        for batch in words.slices(batches, "text"):
            ids, begins = encoder.encode(batch.column("text"))
            sizes = np.diff(begins) + 1
            # Each document's ids move on by the number of ends before it.
            out = np.full(len(ids) + len(sizes), end_id, np.int32)
            keep = np.ones(len(out), bool)
            keep[np.cumsum(sizes) - 1] = False
            out[keep] = ids
            del ids, keep
            # The shard ends with the document that fills it, not with the slice, which may hold many more.
            doc_ids, ends, k = batch.column("doc_id").to_pylist(), np.cumsum(sizes), 0
            while k < len(sizes):
                done = int(ends[k - 1]) if k else 0
                end = min(len(sizes), int(np.searchsorted(ends, done + shard_ids - n_held)) + 1)
                held.append((doc_ids[k:end], out[done : ends[end - 1]], sizes[k:end]))
                n_held, k = n_held + int(ends[end - 1]) - done, end
                if n_held >= shard_ids:
                    yield flush()
        if held:
            yield flush()

    schema = pa.schema([("part_no", pa.int32()), ("shard_no", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).repartitionByRange(n_partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
    shards = materialize(ordered.mapInArrow(words.lean(write), "part_no int, shard_no int, path string, n_docs long, n_ids long"), "shards")
    placed = running(shards, [F.col("part_no"), F.col("shard_no")], {"start": "n_ids"})
    return placed.select("part_no", "shard_no", "path", "n_docs", "n_ids", F.col("start").cast("long").alias("start"))


def read_shards(shards: DataFrame, with_ids: bool = False) -> DataFrame:
    """The documents of shards, each shard decoded by one task: doc_id, start, n_tokens, ids_crc32, and ids on demand."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with files.open_at(row["path"], "r") as f:
                    shard = Shard(f.read())
                ids = shard.all_ids().astype("<u4")
                begins = np.concatenate([[0], shard.id_ends])
                columns = [
                    pa.array(shard.doc_ids, pa.int64(), mask=shard.null.astype(bool)),
                    pa.array(begins[:-1] + row["start"], pa.int64()),
                    pa.array(np.diff(begins), pa.int64()),
                    pa.array([zlib.crc32(ids[a:b]) for a, b in zip(begins, begins[1:], strict=False)], pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(ids, pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])

    spread = shards.select("path", "start").repartition(n_partitions(shards.sparkSession), "path")
    return spread.mapInArrow(words.lean(read), "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op4_token_output(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return read_shards(write_shards(docs, tokenizer_path(), new_path(spark, "tokens")))
