"""Token ids on disk: a range asymmetric numeral system with one shared frequency table.

A file holds whole documents: a directory of ids and lengths, then independent blocks. In a block LANES coders are
interleaved, so one numpy step codes LANES tokens; every CHECKPOINT_STEPS steps the coder states and the place in the
words are noted, and each stretch between two checkpoints can be decoded by itself. Blocks and documents have checksums. The table
is stored once beside the files, each of which names it by its checksum.
"""

from __future__ import annotations

import hashlib
import json
import struct
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shared_dir, table, text_of, written

SLOT_BITS = 18  # frequencies add up to 2**SLOT_BITS
LOW = np.uint64(1 << 31)
LANES, BLOCK_TOKENS, CHECKPOINT_STEPS = 2048, 1 << 19, 128
FILE_TOKENS = 1 << 20
MAGIC = b"RNS2"
HEAD = struct.Struct("<4sQII8s")  # magic, first token, documents, blocks, name of the frequency table
BLOCK = struct.Struct("<IIIII")  # tokens, words, checkpoints, crc32 of the ids, crc32 of the coded bytes
END_ID = 0
CACHE_PIECES = 1_600_000
BATCH_BYTES = 16 << 20  # of texts that a task cuts into pieces at a time; one text may be longer
SIGNS = "!\"#$%&()*+,-./:;=>?@[\\]^_`{}~"  # behind letters they are one token's text; no apostrophe, no part of "<|"
CUT = "\x01"  # where pieces are cut; texts that hold it are encoded whole
_of_worker: dict[str, Pieces] = {}


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to 2**SLOT_BITS, with at least 1 for every id, so that ids never seen can be coded too."""
    total, room = int(counts.sum()), (1 << SLOT_BITS) - len(counts)
    if room < 0:
        raise ValueError("more ids than slots")
    freq = 1 + (counts.astype(np.int64) * room // max(total, 1))
    freq[int(np.argmax(counts))] += (1 << SLOT_BITS) - int(freq.sum())
    return freq.astype(np.uint64)


class Coder:
    """Codes and decodes with one frequency table, which is named by its checksum."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq
        self.name = hashlib.sha256(self.to_bytes()).digest()[:8]
        self.start = np.cumsum(freq) - freq
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64))

    def to_bytes(self) -> bytes:
        return self.freq.astype("<u4").tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes, name: bytes) -> Coder:
        coder = cls(np.frombuffer(raw, "<u4").astype(np.uint64))
        if coder.name != name:
            raise ValueError("the frequency table is damaged")
        return coder

    def encode(self, ids: np.ndarray) -> bytes:
        """One block. The tokens are coded last to first and read first to last; lanes past the end code nothing."""
        steps = -(-len(ids) // LANES)
        state = np.full(LANES, LOW, np.uint64)
        words, marks, used = [], [], 0
        for t in range(steps - 1, -1, -1):
            part = ids[t * LANES : (t + 1) * LANES]
            f, x = self.freq[part], state[: len(part)]
            full = x >= f << np.uint64(63 - SLOT_BITS)
            out = (x[full] & np.uint64(0xFFFFFFFF)).astype("<u4")
            words.append(out)
            used += len(out)
            x = np.where(full, x >> np.uint64(32), x)
            q = x // f
            state[: len(part)] = (q << np.uint64(SLOT_BITS)) + (x - q * f) + self.start[part]
            if t % CHECKPOINT_STEPS == 0:
                marks.append((used, state.copy()))
        stream = np.concatenate(words[::-1]) if words else np.zeros(0, "<u4")
        body = b"".join(struct.pack("<I", used - n) + s.astype("<u8").tobytes() for n, s in marks[::-1]) + stream.tobytes()
        return BLOCK.pack(len(ids), len(stream), len(marks), zlib.crc32(ids.astype("<u4").tobytes()), zlib.crc32(body)) + body

    def stretches(self, raw: bytes, at: int) -> tuple[list[tuple], int, int]:
        """([(tokens, states, words)] that can be decoded independently, crc32 of the ids, where the block ends)."""
        n, n_words, marks, ids_crc, body_crc = BLOCK.unpack_from(raw, at)
        at += BLOCK.size
        size = marks * (4 + 8 * LANES) + 4 * n_words
        body = raw[at : at + size]
        if len(body) != size or zlib.crc32(body) != body_crc:
            raise ValueError("coded bytes are damaged")
        words = np.frombuffer(body, "<u4", n_words, marks * (4 + 8 * LANES))
        out = []
        for k in range(marks):
            off = k * (4 + 8 * LANES)
            (first,) = struct.unpack_from("<I", body, off)
            todo = min(n - k * CHECKPOINT_STEPS * LANES, CHECKPOINT_STEPS * LANES)
            out.append((todo, np.frombuffer(body, "<u8", LANES, off + 4), words[first:]))
        return out, ids_crc, at + size

    def decode(self, n: int, state: np.ndarray, words: np.ndarray) -> np.ndarray:
        """n tokens from a checkpoint."""
        out, state, at = np.empty(n, np.uint32), state.astype(np.uint64), 0
        low = np.uint64((1 << SLOT_BITS) - 1)
        for t in range(0, n, LANES):
            m = min(LANES, n - t)
            x = state[:m]
            slot = x & low
            s = self.symbol[slot]
            out[t : t + m] = s
            x = self.freq[s] * (x >> np.uint64(SLOT_BITS)) + slot - self.start[s]
            need = np.flatnonzero(x < LOW)
            x[need] = (x[need] << np.uint64(32)) | words[at : at + len(need)]
            at += len(need)
            state[:m] = x
        return out


def make_file(coder: Coder, first: int, docs: list[tuple[int | None, np.ndarray]]) -> bytes:
    ids = np.concatenate([d[1] for d in docs])
    blocks = [coder.encode(ids[i : i + BLOCK_TOKENS]) for i in range(0, len(ids), BLOCK_TOKENS)]
    names = b"".join(struct.pack("<?qI", d is None, d or 0, len(x)) for d, x in docs)
    return HEAD.pack(MAGIC, first, len(docs), len(blocks), coder.name) + struct.pack("<I", zlib.crc32(names)) + names + b"".join(blocks)


def read_file(coder: Coder, raw: bytes) -> list[tuple[int | None, int, np.ndarray]]:
    """[(document, start, ids)]; ValueError where a checksum fails."""
    magic, first, n_docs, n_blocks, name = HEAD.unpack_from(raw, 0)
    if magic == MAGIC and name != coder.name:
        raise ValueError(f"the file needs the frequency table {name.hex()}")
    (names_crc,) = struct.unpack_from("<I", raw, HEAD.size)
    at = HEAD.size + 4
    names = raw[at : at + 13 * n_docs]
    if magic != MAGIC or zlib.crc32(names) != names_crc:
        raise ValueError("directory is damaged")
    at += 13 * n_docs
    parts = []
    for _ in range(n_blocks):
        todo, crc, at = coder.stretches(raw, at)
        ids = np.concatenate([coder.decode(*x) for x in todo])
        if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
            raise ValueError("ids are damaged")
        parts.append(ids)
    ids, out, pos = np.concatenate(parts), [], 0
    for null, doc, n in struct.iter_unpack("<?qI", names):
        out.append((None if null else doc, first + pos, ids[pos : pos + n]))
        pos += n
    return out


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(c if c in plain else next(other)) for c in range(256)]


class _Numbers(dict):
    """piece -> its number, in order of first sight; new pieces are also noted in a list."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece):
        self[piece] = n = len(self)
        self.new.append(piece)
        return n


class Pieces:
    """Ids of texts, tokenised by distinct pieces: a byte-level pre-tokeniser never joins what a line end, or one blank before a
    non-blank, separates, so a text's ids are its pieces' ids in order. Arrow cuts the texts and finds the distinct pieces, so
    the library sees each piece of a worker once: a plain word goes to its BPE model, anything else to its encoder. Texts with
    other runs or kinds of blanks, or with the name of a special token, are encoded whole, and so is every text of a
    tokenizer of another kind."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        if self.tok.get_vocab_size() > 1 << 16:
            raise ValueError("ids above 16 bits")
        how = json.loads(self.tok.to_str())
        split, model = how.get("pre_tokenizer") or {}, how["model"]
        self.by_piece = (
            (split.get("type"), split.get("add_prefix_space"), split.get("use_regex"), how.get("normalizer"), model["type"]) == ("ByteLevel", False, True, None, "BPE")
            and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
        )
        self.letters = byte_letters()
        self.blank = self.letters[32]
        self.plain = Tokenizer(self.model)
        self.plain.pre_tokenizer = pre_tokenizers.Split(" ", "removed")
        names = self.tok.get_vocab(with_added_tokens=False)
        self.size_of = np.zeros(1 + max(names.values()), np.int64)  # in byte letters
        self.size_of[list(names.values())] = list(map(len, names))
        self._forget()

    def _forget(self):
        self.seen, self.flat, self.first, self.odd = _Numbers(), array("H"), array("i", [0]), bytearray()

    def _of_words(self, words: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
        """(ids, how many each word has) of words in byte letters. The model splits many of them at once; what an id stands for
        tells where a word ends."""
        flat, counts = [], []
        for at in range(0, len(words), 2000):
            some = words[at : at + 2000]
            ids = np.array(self.plain.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, np.int64)
            stop = np.searchsorted(np.cumsum(self.size_of[ids]), np.cumsum(list(map(len, some)))) + 1
            flat.append(ids.astype(np.uint16))
            counts.append(np.diff(stop, prepend=0))
        return flat, np.concatenate([*counts, np.zeros(0, np.int64)])

    def _learn(self) -> None:
        """The pieces that were new in a batch get their ids: those of a word and of the signs behind it, or of the whole piece."""
        words, rests, word_of, rest_of, odd = _Numbers(), _Numbers(), [], [], bytearray()
        for piece in self.seen.new:
            core = piece.rstrip(SIGNS)
            word = core[1:] if core[:1] == " " else core
            if word.isascii() and word.isalpha():
                word_of.append(words[core.replace(" ", self.blank)])
                rest_of.append(rests[piece[len(core) :]])
                odd.append(False)
            elif word.isalpha() and max(word) < "\u0250":  # letters by any version of Unicode
                word_of.append(words["".join(map(self.letters.__getitem__, core.encode()))])
                rest_of.append(rests[piece[len(core) :]])
                odd.append(False)
            else:
                word_of.append(-1)
                rest_of.append(rests[piece])
                bare = piece[1:] if piece[:1] == " " else piece
                odd.append(piece != "\n" and (bare.split() != [bare] if bare else piece != "") or "<|" in piece)
        self.seen.new.clear()
        flat, size = self._of_words(words.new)
        others = [self._whole(r) for r in rests.new]
        size = np.r_[size, [len(x) for x in others], 0].astype(np.int64)  # the last is of no word
        flat, begin = np.concatenate([*flat, *others, np.zeros(0, np.uint16)]), np.cumsum(size) - size
        use = np.stack([word_of, np.array(rest_of, np.int64) + len(words.new)], axis=1).ravel() if word_of else np.zeros(0, np.int64)
        n = size[use]
        self.flat.frombytes(flat[np.repeat(begin[use] - (np.cumsum(n) - n), n) + np.arange(n.sum())].tobytes())
        self.first.frombytes((self.first[-1] + np.cumsum(n.reshape(-1, 2).sum(axis=1))).astype(np.int32).tobytes())
        self.odd += odd

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, np.uint16)

    def ids(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text of a string column without nulls."""
        if not self.by_piece:
            return [self._whole(t.as_py()) for t in texts]
        if len(self.seen) > CACHE_PIECES:
            self._forget()
        whole = pc.match_substring_regex(texts, f" $|  | \n|\n\n\n|\n\n |\n\n$|{CUT}").to_numpy(zero_copy_only=False)
        parts = pc.split_pattern(pc.replace_substring(pc.replace_substring(texts, " ", CUT + " "), "\n", f"{CUT}\n{CUT}"), CUT)
        pieces = parts.flatten().dictionary_encode()
        names = pieces.dictionary.to_numpy(zero_copy_only=False)
        numbers = np.fromiter(map(self.seen.__getitem__, names), np.int64, len(names))
        self._learn()
        flat, first, odd = np.frombuffer(self.flat, np.uint16), np.frombuffer(self.first, np.int32), np.frombuffer(self.odd, bool)
        at = pieces.indices.to_numpy(zero_copy_only=False)
        lo, n = first[numbers][at], np.diff(first)[numbers][at]
        ends = np.cumsum(n)
        where = np.repeat((lo - (ends - n)).astype(np.int32), n)
        where += np.arange(len(where), dtype=np.int32)
        out = flat[where]
        edges = parts.offsets.to_numpy() - parts.offsets[0].as_py()
        strange = np.r_[0, np.cumsum(odd[numbers][at])]
        whole |= strange[edges[1:]] > strange[edges[:-1]]
        del flat, first, odd  # the arrays can grow again
        cut = np.r_[0, ends][edges]
        return [self._whole(texts[k].as_py()) if w else out[a:b] for k, (w, a, b) in enumerate(zip(whole.tolist(), cut[:-1].tolist(), cut[1:].tolist()))]


def pieces_of_worker(path: str) -> Pieces:
    """One cache for all tasks that a Python worker runs; a new worker starts with an empty one."""
    if path not in _of_worker:
        _of_worker[path] = Pieces(path)
    return _of_worker[path]


def tokenised(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(part, doc, local, n, ids): ids as little-endian 16-bit numbers with END_ID appended, by ascending doc (nulls first).

    part ascends with doc, and local counts the ids before the document in its part. A null text is empty. Rows that repeat
    a doc follow each other in the order of the table, and many rows of one doc are dealt over several tasks.
    """

    def run(batches):
        from pyspark import TaskContext

        part, pieces, local = TaskContext.get().partitionId(), pieces_of_worker(path), 0
        for b in batches:
            sizes = np.cumsum(pc.binary_length(b.column(1)).to_numpy(zero_copy_only=False))
            lo = 0
            while lo < b.num_rows:
                done = sizes[lo - 1] if lo else 0
                hi = max(lo + 1, int(np.searchsorted(sizes, done + BATCH_BYTES, side="right")))
                ids = [np.r_[x, np.uint16(END_ID)].astype("<u2") for x in pieces.ids(b.column(1).slice(lo, hi - lo))]
                n = [len(x) for x in ids]
                before = local + np.cumsum([0, *n[:-1]])
                local += sum(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(n)), b.column(0).slice(lo, len(n)), pa.array(before), pa.array(n), pa.array([x.tobytes() for x in ids], pa.binary())], ["part", "doc", "local", "n", "ids"]
                )
                lo = hi

    src = docs.select(docs[id_col].cast("long").alias("doc"), F.monotonically_increasing_id().alias("at"), text_of(docs, text_col).alias("text"))
    dealt = src.repartitionByRange("doc", "at").sortWithinPartitions("doc", "at")
    return dealt.select("doc", "text").mapInArrow(run, "part long, doc long, local long, n long, ids binary")


def encode(tokens: DataFrame, vocabulary: int) -> tuple[DataFrame, Coder]:
    """(first, body) files of whole documents, and the coder with the table counted over all tokens."""

    def count(batches):
        total = np.zeros(vocabulary, np.int64)
        for b in batches:
            ids = np.frombuffer(b"".join(b.column(0).to_pylist()), "<u2")
            for at in range(0, len(ids), 1 << 22):
                total += np.bincount(ids[at : at + (1 << 22)], minlength=vocabulary)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])

    counts = np.zeros(vocabulary, np.int64)
    for r in tokens.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():  # at most the vocabulary
        counts[r.id] = r.n
    coder = Coder(frequencies(counts))
    table_ = coder.freq

    def run(batches):
        own = Coder(table_)
        held, first, size = [], 0, 0
        out = lambda: pa.RecordBatch.from_arrays([pa.array([first]), pa.array([make_file(own, first, held)], pa.binary())], ["first", "body"])
        for b in batches:
            for start, doc, ids in zip(*(b.column(i) for i in range(3))):
                if held and (size >= FILE_TOKENS or start.as_py() != first + size):
                    yield out()
                    held = []
                if not held:
                    first, size = start.as_py(), 0
                held.append((doc.as_py(), np.frombuffer(ids.as_py(), "<u2").astype(np.int64)))
                size += len(held[-1][1])
        if held:
            yield out()

    sums = tokens.groupBy("part").agg(F.sum("n").alias("n"))
    before = sums.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))  # one row a task
    placed = tokens.join(F.broadcast(before), "part").select((F.col("base") + F.col("local")).alias("start"), "doc", "ids")
    return placed.mapInArrow(run, "first long, body binary"), coder


def decode(files: DataFrame, coder: Coder) -> DataFrame:
    """(doc, start, n_tokens, ids_crc32) of every document in the files."""
    freq = coder.freq

    def run(batches):
        own = Coder(freq)
        for b in batches:
            for raw in b.column(0):
                rows = [(d, s, len(x), zlib.crc32(x.astype("<u4").tobytes())) for d, s, x in read_file(own, raw.as_py())]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["doc", "start", "n_tokens", "ids_crc32"])

    return files.select("body").mapInArrow(run, "doc long, start long, n_tokens long, ids_crc32 long")


def save(files: DataFrame, coder: Coder, path: str) -> None:
    """An archive of its own: the files, and once the frequency table that each of them names."""
    files.write.option("compression", "none").parquet(f"{path}/files")
    files.sparkSession.createDataFrame([(bytearray(coder.name), bytearray(coder.to_bytes()))], "name binary, frequencies binary").coalesce(1).write.parquet(f"{path}/table")


def load(spark, path: str) -> tuple[DataFrame, Coder]:
    """The files (first, body) of a saved archive and the coder for them; ValueError where the table fails its checksum."""
    row = spark.read.parquet(f"{path}/table").first()
    return spark.read.schema("first long, body binary").parquet(f"{path}/files"), Coder.from_bytes(bytes(row.frequencies), bytes(row.name))


def op3_token_ids(spark, sf_dir: str, vocabulary_file: str = "byte_bpe_50k.json") -> DataFrame:
    """The contract query: all documents tokenised, coded to files, and read back."""
    import public_tokenizers

    tokens = written(tokenised(table(spark, sf_dir, "documents"), public_tokenizers.path(vocabulary_file)), "ids")
    path = shared_dir(spark, "rans")
    save(*encode(tokens, 50_257), path)
    return decode(*load(spark, path)).withColumnRenamed("doc", "doc_id")
