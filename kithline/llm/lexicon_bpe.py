"""BPE encoding by a minimal acyclic transducer of frequent words, and decoding.

A word here is a unit of :mod:`.tokens`: leading white space and what follows.
Every task counts the words of all its texts and names its most frequent; those
that are most frequent over all become the lexicon.  Sorted, they are compiled
into the minimal automaton (equal suffixes share states); an arc carries how
many words sort before those behind it, so the sum along a word's path is its
number, which indexes its ids.  The arrays go into one file in the shared
folder, which Spark hands to every executor, where workers memory-map it.

A step's distinct words walk the automaton together, byte by byte; words that it
does not accept are merged by the tokenizer's own merge ranks: short ones together,
a pass for each merge; a long one alone, by a heap of its pairs over a linked list,
in n log n steps.  So the lexicon decides the time taken and never an id.

The file's name is the digest of what it holds, so that calls over the same corpus
share one.  It stays in the shared folder while the application runs, because Spark
hands it to executors that are started later, too.

Defined results: a null text is empty, without ids; a very long text, or one without
any space, is encoded whole; an empty table gives an empty lexicon and an empty
table; repeated rows get equal values; of words that are equally frequent the whole
step of frequency is taken or left; of equal merge ranks the leftmost pair merges
first; other columns, whatever their names, are ignored.  A tokenizer file of
another kind than byte-level BPE with its usual pattern is refused.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import STEP_BYTES, forget, frugal, shared_dir, slices, stored, text_column
from .tokens import byte_names, spread, units_of

#: Words of the lexicon, and words that a task names, at most.
LEXICON = 1 << 16
#: Parts of words whose merges a worker remembers; then it starts anew.
REMEMBERED = 300_000
#: Longer words are left to the merges.
WORD_BYTES = 64
#: Parts of words up to so many bytes merge together, a pass for each merge; longer ones alone, by a heap.
TOGETHER_BYTES = 128


def frequent_words(docs: DataFrame, text: str = "text", size: int = LEXICON) -> list[bytes]:
    """The lexicon's words: all that occur as often as allows for at most ``size``.

    Words are counted by steps of their frequency (sixteen for each power of
    two), and whole steps are taken from the top, so that only the lexicon itself
    reaches the driver.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        total = None
        for part in slices(batches, "text", STEP_BYTES // 2):
            units = units_of(text_column(part, "text"))[0]
            units = units.filter(pc.less_equal(pc.binary_length(units), WORD_BYTES))
            counted = pc.value_counts(units)
            own = pa.table({"word": counted.field(0), "n": counted.field(1)})
            total = own if total is None else pa.concat_tables([total, own]).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])
            if total.num_rows > 16 * size:  # what is rare so far leaves, so that memory stays bounded
                total = total.take(pc.select_k_unstable(total, 8 * size, [("n", "descending")]))
        if total is not None:
            top = total.take(pc.select_k_unstable(total, min(size, total.num_rows), [("n", "descending")]))
            yield from top.combine_chunks().to_batches()

    counts = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "word binary, n long")
    step = F.floor(F.log2("n") * 16).cast("int")
    whole = stored(counts.groupBy("word").agg(F.sum("n").alias("n")).select("word", step.alias("step")), "frequent")
    least, sofar = 1 << 30, 0
    for r in sorted(whole.groupBy("step").count().collect(), reverse=True):  # at most 1,024 rows
        sofar += r["count"]
        if sofar > size:
            break
        least = r["step"]
    found = [bytes(r[0]) for r in whole.filter(F.col("step") >= least).select("word").collect()]
    forget(whole)
    return found


class Automaton:
    """Minimal acyclic automaton of sorted distinct words, built one word after the other."""

    def __init__(self, words: list[bytes]):
        self.register: dict[tuple, int] = {}
        self.arcs: list[tuple[tuple[int, int], ...]] = []  # (byte, state) of each finished state
        self.final: list[bool] = []
        open_states: list[list] = [[False, []]]  # final, arcs; the last arc of each leads to the next
        before = b""
        for word in words:
            same = 0
            while same < min(len(before), len(word)) and before[same] == word[same]:
                same += 1
            self._close(open_states, before, same)
            open_states += [[False, []] for _ in word[same:]]
            open_states[-1][0] = True
            before = word
        self._close(open_states, before, 0)
        self.root = self._finish(open_states[0])
        behind = [0] * len(self.arcs)  # words accepted from each state; states finish after those they lead to
        for s, arcs in enumerate(self.arcs):
            behind[s] = self.final[s] + sum(behind[t] for _, t in arcs)
        self.keys, self.targets, self.skips = [], [], []
        for s, arcs in enumerate(self.arcs):
            skip = int(self.final[s])
            for byte, t in arcs:
                self.keys.append(s << 8 | byte)
                self.targets.append(t)
                self.skips.append(skip)
                skip += behind[t]

    def _finish(self, state: list) -> int:
        key = (state[0], tuple(state[1]))
        if key not in self.register:
            self.register[key] = len(self.arcs)
            self.arcs.append(key[1])
            self.final.append(state[0])
        return self.register[key]

    def _close(self, open_states: list[list], word: bytes, depth: int) -> None:
        while len(open_states) > depth + 1:
            done = self._finish(open_states.pop())
            open_states[-1][1].append((word[len(open_states) - 1], done))


def compiled(words: list[bytes], file: str) -> bytes:
    """The lexicon as one file: a line that describes the arrays, then the arrays."""
    words = sorted(words)
    made, merges = Automaton(words), Merges(file)
    ids = [np.frombuffer(x, "<u4") for x in merges.encode_many(words)]
    arrays = {
        "keys": np.array(made.keys, "<i8"), "targets": np.array(made.targets, "<i4"), "skips": np.array(made.skips, "<i4"), "final": np.array(made.final, "u1"),
        "lengths": np.array([len(x) for x in ids], "<i8"), "ids": np.concatenate(ids).astype("<u4") if ids else np.zeros(0, "<u4"),
    }
    head, at = {"root": made.root, "longest": max(map(len, words), default=0), "arrays": {}}, 0
    for name, a in arrays.items():
        head["arrays"][name] = [a.dtype.str, len(a), at]
        at += -(-a.nbytes // 8) * 8
    line = json.dumps(head).encode()
    line += b" " * (-(len(line) + 1) % 8) + b"\n"
    return line + b"".join(a.tobytes() + b"\0" * (-a.nbytes % 8) for a in arrays.values())


class Merges:
    """Exact merges of words: pattern, then byte pairs by rank, as the tokenizer file has them.

    Each word merges its pair of the lowest rank, the leftmost of equal ones, and
    then looks again; all words of a call take a step together.
    """

    NONE = np.iinfo(np.int32).max

    def __init__(self, file: str):
        import regex

        with open(file, encoding="utf-8") as f:
            model = json.load(f)
        usual = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        plain = model["model"]["type"] == "BPE" and not any(model["model"].get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        if model.get("normalizer") or not plain or any((model.get("pre_tokenizer") or {}).get(k) != v for k, v in usual.items()):
            raise ValueError(f"{file} is not a byte-level BPE with the usual pattern")
        vocab, merges = model["model"]["vocab"], model["model"]["merges"]
        as_bytes = {c: bytes([b]) for b, c in enumerate(byte_names())}
        raw = lambda s: b"".join(as_bytes[c] for c in s)
        added = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.added = {t.encode(): np.array([i], "<u4").tobytes() for t, i in added.items()}
        ids = {raw(t): i for t, i in vocab.items() if t not in added}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left, right = (np.array([ids[raw(p[k])] for p in pairs], np.int64) for k in (0, 1))
        self.made = np.array([ids[raw(a + b)] for a, b in pairs], np.int32)
        self.base = max(vocab.values()) + 1
        order = np.argsort(left * self.base + right)
        self.keys, self.ranks = (left * self.base + right)[order], order.astype(np.int32)
        self.bytes = np.array([ids[bytes([b])] for b in range(256)], np.int32)
        first, second = np.divmod(np.arange(1 << 16), 256)
        self.byte_ranks = self.rank(self.bytes[first], self.bytes[second])
        self.rank_of = dict(zip((left * self.base + right).tolist(), range(len(left)), strict=True))
        self.cut = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
        self.special = regex.compile(b"|".join(map(regex.escape, self.added))) if added else None
        self.known = dict(self.added)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The merge ranks of pairs of ids."""
        key = a.astype(np.int64) * self.base + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], self.NONE)

    def pieces(self, word: bytes) -> list[bytes]:
        """The parts that the pattern cuts a word into, added tokens whole."""
        if word[word[:1] == b" " :].isalpha():
            return [word]
        out, at = [], 0
        for m in self.special.finditer(word) if self.special and b"<" in word else ():
            out += [x.encode() for x in self.cut.findall(word[at : m.start()].decode())] + [m.group()]
            at = m.end()
        return out + [x.encode() for x in self.cut.findall(word[at:].decode())]

    def encode_many(self, words: list[bytes]) -> list[bytes]:
        """Each word's ids as little-endian 32-bit integers."""
        cut = [self.pieces(w) for w in words]
        if len(self.known) > REMEMBERED:
            self.known = dict(self.added)
        known = self.known
        unknown = {p for ps in cut for p in ps if p not in known}
        alone = {p: self.merged_alone(p).tobytes() for p in unknown if len(p) > TOGETHER_BYTES}
        new = [p for p in unknown if len(p) <= TOGETHER_BYTES]
        flat, lengths = self.merged(new)
        raw, ends = flat.tobytes(), np.cumsum(lengths) * 4
        known.update((p, raw[a:z]) for p, a, z in zip(new, (ends - 4 * lengths).tolist(), ends.tolist(), strict=True))
        return [b"".join(alone[p] if p in alone else known[p] for p in ps) for ps in cut]

    def merged_alone(self, word: bytes) -> np.ndarray:
        """Ids of one word: the pair of the lowest rank, then of the leftmost place, from a heap; places form a linked list."""
        data, n, base, none = np.frombuffer(word, np.uint8), len(word), self.base, self.NONE
        symbol = self.bytes[data].tolist()
        now = self.byte_ranks[data[:-1].astype(np.int64) << 8 | data[1:]].tolist() + [none]  # the rank of the pair that begins at each place
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [r << 40 | i for i, r in enumerate(now) if r != none]
        heapq.heapify(heap)
        made, rank_of, place = self.made.tolist(), self.rank_of, (1 << 40) - 1
        while heap:
            entry = heapq.heappop(heap)
            rank, i = entry >> 40, entry & place
            if now[i] != rank:  # one of the two has been merged meanwhile
                continue
            j = after[i]
            k = after[j]
            symbol[i], symbol[j], now[j], after[i] = made[rank], -1, none, k
            now[i] = none
            if k < n:
                before[k] = i
                now[i] = rank_of.get(symbol[i] * base + symbol[k], none)
                if now[i] != none:
                    heapq.heappush(heap, now[i] << 40 | i)
            h = before[i]
            if h >= 0:
                now[h] = rank_of.get(symbol[h] * base + symbol[i], none)
                if now[h] != none:
                    heapq.heappush(heap, now[h] << 40 | h)
        out = np.array(symbol, np.int64)
        return out[out >= 0].astype("<u4")

    def merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words as one array, and how many each has."""
        lengths = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words), np.uint8)
        out_lengths, done = lengths.copy(), []
        word = np.repeat(np.arange(len(words)), lengths)
        symbol, rank = self.bytes[data], np.full(len(data), self.NONE, np.int32)
        if len(data) > 1:
            same = np.flatnonzero(word[1:] == word[:-1])
            rank[same] = self.byte_ranks[data[same].astype(np.int64) << 8 | data[same + 1]]
        while len(symbol):
            heads = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            size = np.diff(np.r_[heads, len(word)])
            best = np.minimum.reduceat(rank, heads)
            ended = best == self.NONE
            if ended.any():
                stay = np.repeat(~ended, size)
                done.append((word[~stay], symbol[~stay]))
                word, symbol, rank = word[stay], symbol[stay], rank[stay]
                size, best = size[~ended], best[~ended]
                if not len(symbol):
                    break
            hit = np.flatnonzero(rank == np.repeat(best, size))
            at = hit[np.r_[True, word[hit[1:]] != word[hit[:-1]]]]
            symbol[at] = self.made[best]
            out_lengths[word[at]] -= 1
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            word, symbol, rank = word[keep], symbol[keep], rank[keep]
            at -= np.arange(len(at))
            rank[at] = self.NONE
            follows = at[at + 1 < len(word)]
            follows = follows[word[follows + 1] == word[follows]]
            rank[follows] = self.rank(symbol[follows], symbol[follows + 1])
            before = at[at > 0] - 1
            before = before[word[before] == word[before + 1]]
            rank[before] = self.rank(symbol[before], symbol[before + 1])
        if not done:
            return np.zeros(0, "<u4"), out_lengths
        order = np.argsort(np.concatenate([w for w, _ in done]), kind="stable")
        return np.concatenate([x for _, x in done])[order].astype("<u4"), out_lengths


class Lexicon:
    """The memory-mapped automaton, with merges for words it does not accept."""

    def __init__(self, path: str, file: str):
        with open(path, "rb") as f:
            line = f.readline()
        head = json.loads(line)
        mapped = np.memmap(path, np.uint8, "r")
        for name, (kind, n, at) in head["arrays"].items():
            begin = len(line) + at
            setattr(self, name, mapped[begin : begin + n * np.dtype(kind).itemsize].view(kind))
        self.root, self.longest = head["root"], head["longest"]
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.merges = Merges(file)
        with open(file, encoding="utf-8") as f:
            model = json.load(f)
        as_bytes = {c: bytes([b]) for b, c in enumerate(byte_names())}
        added = {t["id"]: t["content"].encode() for t in model["added_tokens"]}
        pieces = {i: b"".join(as_bytes[c] for c in t) for t, i in model["model"]["vocab"].items() if i not in added} | added
        ordered = [pieces.get(i, b"") for i in range(max(pieces) + 1)]
        self.piece_bytes = np.frombuffer(b"".join(ordered), np.uint8)
        self.piece_sizes = np.array([len(p) for p in ordered], np.int64)

    def numbers(self, words: pa.Array) -> np.ndarray:
        """Each word's number in the lexicon, -1 for others."""
        n = len(words)
        out = np.full(n, -1, np.int64)
        if not n or not len(self.keys):
            return out
        offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + n + 1].astype(np.int64)
        data, sizes = np.frombuffer(words.buffers()[2] or b"\0", np.uint8), np.diff(offsets)
        live = np.flatnonzero((sizes <= self.longest) & (sizes > 0))
        state, number, depth = np.full(len(live), self.root, np.int64), np.zeros(len(live), np.int64), 0
        while len(live):
            key = state << 8 | data[offsets[live] + depth]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[arc] == key
            live, arc = live[ok], arc[ok]
            number = number[ok] + self.skips[arc]
            state, depth = self.targets[arc].astype(np.int64), depth + 1
            ended = sizes[live] == depth
            accepted = ended & (self.final[state] == 1)
            out[live[accepted]] = number[accepted]
            live, state, number = live[~ended], state[~ended], number[~ended]
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of null-free texts as one array, and each text's bounds in it."""
        units, bounds = units_of(texts)
        if not len(units):
            return np.zeros(0, "<u4"), np.zeros(len(texts) + 1, np.int64)
        coded = units.dictionary_encode()
        number = self.numbers(coded.dictionary)
        other = np.flatnonzero(number < 0)
        merged = self.merges.encode_many(coded.dictionary.take(pa.array(other)).to_pylist())
        flat = np.concatenate([self.ids, np.frombuffer(b"".join(merged), "<u4")])
        own = np.array([len(m) for m in merged], np.int64) // 4
        starts, sizes = np.empty(len(number), np.int64), np.empty(len(number), np.int64)
        inside = number >= 0
        starts[inside], sizes[inside] = self.starts[number[inside]], self.lengths[number[inside]]
        starts[other], sizes[other] = len(self.ids) + np.cumsum(own) - own, own
        index = coded.indices.to_numpy()
        upto = np.zeros(len(index) + 1, np.int64)
        np.cumsum(sizes[index], out=upto[1:])
        kind = np.int32 if max(len(flat), int(upto[-1])) < 1 << 31 else np.int64
        at = np.repeat((starts[index] - upto[:-1]).astype(kind), sizes[index])
        at += np.arange(upto[-1], dtype=kind)
        return flat[at], upto[bounds]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of all texts and each text's bounds in them."""
        raw, upto = spread(self.piece_bytes, self.piece_sizes, ids)
        return raw.tobytes(), upto[bounds]


_LEXICONS: dict[str, Lexicon] = {}


def opened(name: str, file: str) -> Lexicon:
    """This process's lexicon of a file that Spark handed to the executor."""
    if name not in _LEXICONS:
        _LEXICONS.clear()
        _LEXICONS[name] = Lexicon(SparkFiles.get(name), file)
    return _LEXICONS[name]


def publish(spark: SparkSession, body: bytes) -> str:
    """Put a lexicon file into the shared folder and hand it to all executors, also to later ones; its name."""
    name = f"lexicon-{hashlib.sha256(body).hexdigest()[:32]}.bin"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/kithline/{name}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        staged = path.suffix(f".{uuid.uuid4().hex}")
        out = files.create(staged)
        out.write(body)
        out.close()
        if not files.rename(staged, path):  # another session has put the same there
            files.delete(staged, False)
    spark.sparkContext.addFile(path.toString())
    return name


def build(docs: DataFrame, file: str, text: str = "text", size: int = LEXICON) -> str:
    """Compile and publish the lexicon of a corpus."""
    return publish(docs.sparkSession, compiled(frequent_words(docs, text, size), file))


def round_trip(docs: DataFrame, file: str, doc_id: str = "doc_id", text: str = "text", size: int = LEXICON) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and the decoded_sha256 of the decoded text of every document."""
    name = build(docs, file, text, size)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        for part in slices(batches, "text", STEP_BYTES // 2):
            lexicon = opened(name, file)
            ids, bounds = lexicon.encode(text_column(part, "text"))
            raw, at = lexicon.decode(ids, bounds)
            sha = lambda b: hashlib.sha256(b).hexdigest()
            as_bytes, pairs = ids.tobytes(), lambda x: zip(x[:-1].tolist(), x[1:].tolist(), strict=True)
            yield pa.record_batch({
                "doc_id": part.column(0), "n_tokens": pa.array(np.diff(bounds)),
                "ids_sha256": pa.array([sha(as_bytes[4 * a : 4 * z]) for a, z in pairs(bounds)], pa.string()),
                "decoded_sha256": pa.array([sha(raw[a:z].decode("utf-8", "replace").encode()) for a, z in pairs(at)], pa.string()),
            })

    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return given.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encoded(docs: DataFrame, file: str, doc_id: str = "doc_id", text: str = "text", size: int = LEXICON) -> DataFrame:
    """doc_id and ids (little-endian 32-bit integers) of every document."""
    name = build(docs, file, text, size)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        for part in slices(batches, "text", STEP_BYTES // 2):
            ids, bounds = opened(name, file).encode(text_column(part, "text"))
            raw = ids.tobytes()
            bodies = [raw[4 * a : 4 * z] for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            yield pa.record_batch({"doc_id": part.column(0), "ids": pa.array(bodies, pa.binary())})

    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return given.mapInArrow(run, "doc_id long, ids binary")
