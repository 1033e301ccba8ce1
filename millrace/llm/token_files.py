"""Token ids in flat binary files with 64-bit document offsets.

A set of token files has, for each part, ``<name>.bin``: the ids as little-endian unsigned
integers, of 16 bits where the vocabulary allows and of 32 bits otherwise (``width`` in the
manifest has the bytes), one document after the other, and ``<name>.idx``: little-endian signed
64-bit pairs (document id, end of the document in ids, counted from the start of the part).
The parts hold ascending document ids. The base of a part is the prefix sum of the parts
before it, and is kept in the manifest, not in the files, so parts are written without
knowing one another.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import textops
from millrace.llm.bpe import _ranges
from millrace.llm.shipping import arrow_batches
from millrace.operators.staging import stage

MANIFEST = "part int, name string, width int, first_id long, docs long, tokens long"
#: Encoded words that a worker remembers at most.
REMEMBERED = 300_000
#: Bytes of text that a worker holds at once, unless one document is longer.
ARROW_BATCH = 4 << 20
_PUNCTUATION = np.array([33 <= b <= 126 and not chr(b).isalnum() and b != 39 for b in range(256)])
_ALNUM = np.array([chr(b).isalnum() and b < 128 for b in range(256)])


def _open(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri if "://" in uri else "file://" + re.sub("^file:", "", uri))


class WordEncoder:
    """Ids of texts by a tokenizer, each distinct word encoded once where words stand for themselves.

    They do if no match runs across ASCII white space, which is dropped, the input is lowered, each
    word's last token says so, and the marks at the end of a word are matches of their own after a
    letter or digit, unless the word has an apostrophe. The file must declare the lowering and the
    marked tokens, and ``PROBES`` must come out as from the library; otherwise texts are encoded whole.
    A word that holds an added token (a special one, say) goes to the library as it is.
    """

    def __init__(self, path: str):
        # A task has one core; the library's own threads would each keep memory of their own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            declared = json.load(f)
        self.added = [t["content"].encode() for t in declared.get("added_tokens") or ()]
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.width = 2 if len(self.last) <= 1 << 16 else 4
        self.forget()
        self.by_word = self._by_word(declared)

    def _by_word(self, declared: dict) -> bool:
        normalizer = declared.get("normalizer") or {}
        steps = [n.get("type") for n in normalizer.get("normalizers", [normalizer])]
        if "Lowercase" not in steps or not self.last.any() or any(re.search(rb"[\x20\x09-\x0D]", t) for t in self.added):
            return False
        self.by_word = True
        data, offsets = textops.pack(pa.array(PROBES))
        try:
            ids, cuts = self.encode(data, offsets)
        except ValueError:
            return False
        finally:
            self.forget()
        whole = [e.ids for e in self.tokenizer.encode_batch_fast(PROBES, add_special_tokens=False)]
        return [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:], strict=True)] == whole

    def forget(self) -> None:
        self.slots: dict[bytes, int] = {}
        self.ids: list[np.ndarray] = []
        self.ends = np.zeros(1, np.int64)

    def _ids(self, texts: list[str], many: int) -> list[np.ndarray]:
        """Ids of each text, ``many`` encoded at once, since the library's results are large."""
        out = []
        for k in range(0, len(texts), many):
            out += [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts[k : k + many], add_special_tokens=False)]
        return out

    def _encode_words(self, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, their number by word). Words of letters only are one match each, and are encoded many to a line."""
        plain = np.array([w.isalpha() and w.lower().isalpha() for w in names], bool)
        counts = np.zeros(len(names), np.int64)
        lines = [names[i] for i in np.flatnonzero(plain)]
        lines = [" ".join(lines[i : i + 500]) for i in range(0, len(lines), 500)]
        found = self._ids(lines, 16)
        joined = np.concatenate(found) if found else np.zeros(0, np.uint32)
        ends = np.flatnonzero(self.last[joined]) + 1
        if len(ends) != plain.sum():
            raise ValueError("the tokenizer does not mark the end of each word")
        counts[plain] = np.diff(ends, prepend=0)
        rest = self._ids([names[i] for i in np.flatnonzero(~plain)], 4096)
        counts[~plain] = [len(r) for r in rest]
        starts = np.cumsum(counts) - counts
        ids = np.zeros(int(counts.sum()), np.uint32)
        ids[_ranges(starts[plain], counts[plain])] = joined
        if rest:
            ids[_ranges(starts[~plain], counts[~plain])] = np.concatenate(rest)
        return ids, counts

    def _learn(self, names: list[bytes]) -> None:
        ids, sizes = self._encode_words([name.decode() for name in names])
        self.ids.append(ids)
        for name in names:
            self.slots[name] = len(self.slots)
        self.ends = np.concatenate((self.ends, self.ends[-1] + np.cumsum(sizes)))

    def _whole(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        found = self._ids([raw[i:j].decode() for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], 16)
        return np.concatenate([*found, np.zeros(0, np.uint32)]), np.cumsum([0, *map(len, found)])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets in ids) of the texts."""
        if not self.by_word:
            return self._whole(data, offsets)
        given, data = data, textops.lower_ascii(data)
        a, b, first = textops.words(data, offsets)
        if not len(a):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        # Also where only the lowered word would hold one.
        special = self._special(given, a) | self._special(data, a)
        for i in np.flatnonzero(special).tolist():
            data[a[i] : b[i]] = given[a[i] : b[i]]
        # Split off the marks at the end of a word.
        quotes = np.concatenate(([0], np.cumsum(data == 39)))
        mark = _PUNCTUATION[data]
        since = np.maximum.accumulate(np.where(mark, -1, np.arange(len(data))))  # last place that is no mark
        cut = since[b - 1] + 1
        split = (cut < b) & (cut > a) & _ALNUM[data[np.maximum(cut - 1, 0)]] & (quotes[b] == quotes[a]) & ~special
        starts = np.concatenate((a, cut[split]))
        ends = np.concatenate((np.where(split, cut, b), b[split]))
        order = np.argsort(starts, kind="stable")
        starts, ends = starts[order], ends[order]
        cuts = np.searchsorted(starts, offsets)
        codes, names = textops.distinct(data, starts, ends)
        if len(self.slots) + len(names) > REMEMBERED:
            self.forget()
        slots = np.fromiter(map(self.slots.get, names, repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(slots < 0)
        if len(new):
            slots[new] = np.arange(len(self.slots), len(self.slots) + len(new))
            self._learn([names[i] for i in new.tolist()])
        if len(self.ids) > 1:
            self.ids = [np.concatenate(self.ids)]
        used = slots[codes]
        sizes = self.ends[used + 1] - self.ends[used]
        total = np.concatenate(([0], np.cumsum(sizes)))
        return self.ids[0][_ranges(self.ends[used], sizes)], total[cuts]


    def _special(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Which words hold an added token, as it is written there."""
        out = np.zeros(len(starts), bool)
        raw = data.tobytes()
        for token in self.added:
            at = raw.find(token) if token else -1
            while at >= 0:
                out[np.searchsorted(starts, at, "right") - 1] = True
                at = raw.find(token, at + 1)
        return out


#: Texts that a tokenizer must encode word by word as it does whole.
PROBES = ["Hello, World's 42 times!?  (so-called) a.b...", "don't \t\nÉTÉ naïve §9 x_y 語 '' it's,", "A1b2 -- <i> 3.14% \u2003end "]
_encoders: dict[str, WordEncoder] = {}


def write(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 1, parts: int | None = None) -> DataFrame:
    """Write the ids of ``docs`` (doc_id, text) below ``folder`` and return the manifest, with each part's base.

    ``tokenizer`` is a file that every executor can read, ``folder`` one that all share.
    A null or empty text gives only ``end_id``. Documents lie in ascending ``doc_id``;
    repeated ids lie side by side. A task that runs again writes new files, and the
    manifest names those of the run that counted. An empty table gives an empty manifest.
    """
    parts = parts or max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _encoders:
            _encoders[tokenizer] = WordEncoder(tokenizer)
        encoder = _encoders[tokenizer]
        part = TaskContext.get().partitionId()
        name = f"{part:06d}-{uuid.uuid4().hex}"
        files, where = _open(folder)
        files.create_dir(where, recursive=True)
        docs_done = tokens_done = 0
        first_id = None
        out = None
        for piece in textops.slices(batches, limit=1 << 20):
            if out is None:
                out, index = files.open_output_stream(f"{where}/{name}.bin"), files.open_output_stream(f"{where}/{name}.idx")
            ids, cuts = encoder.encode(*textops.pack(piece.column("text")))
            doc_ids = piece.column("doc_id").to_numpy()
            first_id = int(doc_ids[0]) if first_id is None else first_id
            n = len(doc_ids)
            flat = np.full(len(ids) + n, end_id, np.uint32)
            ends = cuts[1:] + np.arange(1, n + 1)
            keep = np.ones(len(flat), bool)
            keep[ends - 1] = False
            flat[keep] = ids
            out.write(flat.astype(f"<u{encoder.width}").tobytes())
            index.write(np.stack((doc_ids, tokens_done + ends), 1).astype("<i8").tobytes())
            docs_done, tokens_done = docs_done + n, tokens_done + len(flat)
        if out is not None:
            out.close()
            index.close()
            yield pa.record_batch([pa.array([x], t) for x, t in ((part, pa.int32()), (name, pa.string()), (encoder.width, pa.int32()), (first_id, pa.int64()), (docs_done, pa.int64()), (tokens_done, pa.int64()))], names=["part", "name", "width", "first_id", "docs", "tokens"])

    ordered = docs.select("doc_id", "text").repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id")
    with arrow_batches(docs.sparkSession, ARROW_BATCH):
        manifest = stage(ordered.mapInArrow(run, MANIFEST), "manifest")
    # One row for each part.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the files; ``ids`` are little-endian unsigned 32-bit integers.

    Files on a mounted file system are memory-mapped; others are read by range.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, where = _open(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with files.open_input_file(f"{where}/{row['name']}.idx") as f:
                    index = np.frombuffer(f.read(), "<i8").reshape(-1, 2)
                width = row["width"]
                kind = f"<u{width}"
                if isinstance(files, pyarrow.fs.LocalFileSystem):
                    tokens = np.memmap(f"{where}/{row['name']}.bin", kind, "r")
                    stretch = lambda a, b, tokens=tokens: tokens[a:b]
                else:
                    source = files.open_input_file(f"{where}/{row['name']}.bin")
                    stretch = lambda a, b, source=source, width=width, kind=kind: np.frombuffer(source.read_at(width * (b - a), width * a), kind)
                starts = np.concatenate(([0], index[:-1, 1]))
                for k in range(0, len(index), 500):
                    ids, a, b = index[k : k + 500, 0], starts[k : k + 500], index[k : k + 500, 1]
                    yield pa.record_batch(
                        [pa.array(ids), pa.array(a + row["base"]), pa.array(b - a), pa.array([stretch(x, y).astype("<u4").tobytes() for x, y in zip(a.tolist(), b.tolist(), strict=True)], pa.binary())],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )

    spread = manifest.repartition(max(1, manifest.sparkSession.sparkContext.defaultParallelism), "part")
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
