"""Operator 11: alignment of two tokenizers over the same texts.

Both tokenizers read the same bytes; a place where a token of A and one of B end together is a cut,
and the tokens between two cuts are a group. A and B tokens of one group are linked, all with all.

Method (lockstep vectorised merging): the texts of a batch stand side by side as lanes. One NumPy
state vector holds each lane's next A and B token; a step compares the two ends of every lane,
advances the pointer (both, if equal) and, where they are equal, emits the cut and the group's
links. Finished lanes are compacted away. A lane is a text, or a stretch of one: long texts start
further lanes at cuts known beforehand, so one long text does not leave a vector of one place.

Such cuts come from the tokenizing: neither tokenizer has a token across a non-space followed by a
space (checked on their definitions; where it does not hold, texts stay whole), so a text is read as
pieces between these places and each distinct piece is tokenized once per task.

How many documents hold a pair linked is counted from each batch's own counts. The counts are
joined back to each document's pairs: the most frequent pairs (a bounded number by their share of
all rows) are broadcast, the others go through a shuffle join, so a pair that every document holds
does not skew it.

Defined results: texts that are NULL, empty, or whose tokens of either side do not join to the
text's bytes have no tokens: zeros and ''. Each row is a document of its own, also with a repeated
or NULL id. Very long texts are read in slices. Tokenizer files are read once by the driver and sent
as bytes (a fixed size); they need not exist on executors.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe.llm.common import cut_lineage, pick, table

FOLDER, FILE_A, FILE_B = "/opt/tokenizers", "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Tokens of a lane, characters of a slice, characters of one lockstep batch, pieces remembered.
LANE, SLICE, BATCH, REMEMBERED = 256, 1 << 18, 1 << 20, 300_000
#: Pairs broadcast at most: those that hold at least this fraction of all (document, pair) rows.
FREQUENT = 200_000

_CUT = re.compile(r"(?<=\S) ")
_MARK = "▁"


def byte_letters() -> dict[str, int]:
    """The letter of each byte in byte-level vocabularies: printable Latin-1 is itself, the rest follow from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class Pair:
    """Both tokenizers, their tokens' bytes, and whether texts may be read in pieces."""

    def __init__(self, file_a: bytes, file_b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(file_a.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=file_b)
        letters, size = byte_letters(), self.a.get_vocab_size(with_added_tokens=True)
        names = [self.a.id_to_token(i) or "" for i in range(size)]
        self.bytes_a = [bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t in names]
        pieces = [self.b.id_to_piece(i) for i in range(len(self.b))]
        self.bytes_b = [bytes([int(t[3:5], 16)]) if self.b.is_byte(i) else t.replace(_MARK, " ").encode() for i, t in enumerate(pieces)]
        made = json.loads(file_a)
        before = made.get("pre_tokenizer") or {}
        plain = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and not made.get("normalizer")
        special = all(t.get("special") for t in made.get("added_tokens") or [])
        self.in_pieces = bool(plain and special and not any(re.search(f"[^{_MARK}]{_MARK}", t) for t in pieces))

    def tokens(self, texts: list[str]) -> list[tuple[list[int], list[int], bool]]:
        """(A ids of space+text, B ids of text, both join to space+text) per text."""
        out = []
        for x, a, b in zip(texts, self.a.encode_batch([" " + x for x in texts], add_special_tokens=False), self.b.encode(texts, num_threads=1)):
            want = b" " + x.encode()
            out.append((a.ids, b, b"".join(map(self.bytes_a.__getitem__, a.ids)) == want and b"".join(map(self.bytes_b.__getitem__, b)) == want))
        return out

    def joined(self, parts: list[str]) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """For pieces that end in a non-space: A's and B's ids and how many each piece has, from one
        text of all of them; None if that text's bytes are not kept."""
        text = " ".join(parts)
        want, out = b" " + text.encode(), []
        ends = np.cumsum([1 + len(p.encode()) for p in parts])
        for ids, names in ((self.a.encode(" " + text, add_special_tokens=False).ids, self.bytes_a), (self.b.encode(text), self.bytes_b)):
            words = list(map(names.__getitem__, ids))
            if b"".join(words) != want:
                return None
            at = np.cumsum(list(map(len, words)))
            last = np.searchsorted(at, ends)
            if (at[last] != ends).any():
                return None
            out.append((np.array(ids, np.int32), np.diff(last, prepend=-1)))
        return out


def pieces(text: str) -> Iterator[list[str]]:
    """The text as slices of pieces: cut before each space that follows a non-space, the space left
    out; white space at the end stays with the last piece."""
    end = len(text.rstrip())
    at = 0
    while at < len(text):
        cut = _CUT.search(text, at + SLICE, end) if len(text) - at > SLICE else None
        stop = cut.start() if cut else len(text)
        part = _CUT.split(text[at:stop] if cut else text[at:end])
        if not cut:
            part[-1] += text[max(at, end):]
        yield part
        at = stop + 1 if cut else len(text)


class Ragged:
    """Rows of numbers in one growing array, read many at a time."""

    def __init__(self):
        self.values, self.first, self.size = np.zeros(1 << 10, np.int32), np.zeros(1 << 8, np.int64), np.zeros(1 << 8, np.int32)
        self.rows = self.used = 0

    def extend(self, new: np.ndarray, size: np.ndarray) -> None:
        total = self.rows + len(size)
        for name, need in (("values", self.used + len(new)), ("first", total), ("size", total)):
            old = getattr(self, name)
            if need > len(old):
                setattr(self, name, np.concatenate([old, np.zeros(need, old.dtype)]))
        self.values[self.used:self.used + len(new)] = new
        self.first[self.rows:total] = self.used + np.cumsum(size) - size
        self.size[self.rows:total] = size
        self.rows, self.used = total, self.used + len(new)

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows ``at`` joined, and each one's length."""
        n = self.size[at].astype(np.int64)
        return self.values[np.repeat(self.first[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())].astype(np.int64), n


def merge(first_a, end_a, first_b, end_b, ends_a: np.ndarray, ends_b: np.ndarray):
    """Lockstep over lanes: tokens ``first:end`` of each side, ``ends`` the byte offsets where tokens
    end. Gives the cuts (lane, first A, after last A, first B, after last B), in order within a lane,
    and for each link the index of its cut and its A and B token."""
    lane = np.flatnonzero(first_a < end_a)
    a, b, stop = first_a[lane], first_b[lane], end_a[lane]
    from_a, from_b = a.copy(), b.copy()
    cuts, links, made = [], [], 0
    while len(lane):
        x, y = ends_a[a], ends_b[b]
        a, b = a + (x <= y), b + (y <= x)
        here = np.flatnonzero(x == y)
        if len(here):
            fa, fb = from_a[here], from_b[here]
            na, nb = a[here] - fa, b[here] - fb
            cuts.append((lane[here], fa, a[here], fb, b[here]))
            if na.max() == 1 and nb.max() == 1:
                links.append((made + np.arange(len(here)), fa, fb))
            else:
                n = na * nb
                k = np.repeat(np.arange(len(here)), n)
                r = np.arange(len(k)) - np.repeat(np.cumsum(n) - n, n)
                links.append((made + k, fa[k] + r // nb[k], fb[k] + r % nb[k]))
            made += len(here)
            from_a[here], from_b[here] = a[here], b[here]
            done = a == stop
            if done.any():
                keep = np.flatnonzero(~done)
                lane, a, b, stop, from_a, from_b = (v[keep] for v in (lane, a, b, stop, from_a, from_b))
    join = lambda parts, n: [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(n)]
    return join(cuts, 5), join(links, 3)


class Aligner:
    """Tokenizes and merges texts; remembers pieces."""

    def __init__(self, pair: Pair):
        self.pair = pair
        self.size_b = len(pair.bytes_b)
        self.len_a = np.array([len(t) for t in pair.bytes_a])
        self.len_b = np.array([len(t) for t in pair.bytes_b])
        most = max(len(pair.bytes_a), self.size_b)
        # decimal ids with what follows them: ',' within a side, '|' after A, ';' after B
        self.digits = np.zeros((3 * most, len(str(most)) + 1), np.uint8)
        for i in range(most):
            for k, mark in enumerate(b",|;"):
                word = str(i).encode() + bytes([mark])
                self.digits[3 * i + k, :len(word)] = np.frombuffer(word, np.uint8)
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.ids_a, self.ids_b, self.good = Ragged(), Ragged(), []

    def learn(self, parts: list[str]) -> None:
        new = [p for p in dict.fromkeys(parts) if p not in self.place]
        start = 0
        while start < len(new):
            stop, size = start, 0
            while stop < len(new) and (stop == start or size + len(new[stop]) < 1 << 17):
                size += len(new[stop])
                stop += 1
            plain = [self.pair.in_pieces and not p[-1:].isspace() and p != "" for p in new[start:stop]]
            for kind in (True, False):
                self._add([p for p, is_plain in zip(new[start:stop], plain) if is_plain == kind], kind)
            start = stop

    def _add(self, new: list[str], plain: bool) -> None:
        if not new:
            return
        made = self.pair.joined(new) if plain else None
        if made:
            good = [True] * len(new)
        else:
            rows = self.pair.tokens(new)
            good = [r[2] for r in rows]
            made = [(np.array([i for r in rows for i in r[k]], np.int32), np.array([len(r[k]) for r in rows])) for k in (0, 1)]
        self.place.update(zip(new, range(len(self.good), len(self.good) + len(new))))
        self.ids_a.extend(*made[0])
        self.ids_b.extend(*made[1])
        self.good += good

    def align(self, texts: list[str | None]) -> Iterator[dict]:
        """One dict per text, in order."""
        if len(self.place) > REMEMBERED:
            self.forget()
        out = [{"n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "sha": hashlib.sha256(), "pairs": []} for _ in texts]
        held, size = [], 0
        for i, text in enumerate(texts):
            if not text:
                continue
            for part in pieces(text) if self.pair.in_pieces else [[text]]:
                held.append((i, part))
                size += sum(map(len, part)) + len(part)
                if size >= BATCH:
                    self._fold(held, out)
                    held, size = [], 0
        self._fold(held, out)
        for r in out:
            r["sha"] = "" if not r["n_a"] or r["pairs"] is None else r["sha"].hexdigest()
            if r["pairs"] is None:
                r |= {"n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0}
            if not r["pairs"]:
                r["pairs"] = np.zeros(0, np.int64), np.zeros(0, np.int64)
            elif len(r["pairs"]) == 1:
                r["pairs"] = r["pairs"][0]
            else:
                pair, at = np.unique(np.concatenate([p for p, _ in r["pairs"]]), return_inverse=True)
                r["pairs"] = pair, np.bincount(at, np.concatenate([n for _, n in r["pairs"]])).astype(np.int64)
        return iter(out)

    def _fold(self, read: list[tuple[int, list[str]]], out: list[dict]) -> None:
        """Merges slices of texts (index, pieces) and adds what they give to their texts."""
        self.learn(list(chain.from_iterable(part for _, part in read)))
        held = [(i, np.fromiter(map(self.place.__getitem__, part), np.int64, len(part))) for i, part in read]
        good = np.array(self.good, bool)
        bad = {i for i, at in held if not good[at].all()}
        for i in bad:
            out[i]["pairs"] = None
        held = [(i, at) for i, at in held if out[i]["pairs"] is not None]
        if not held:
            return
        owner = np.array([i for i, _ in held])
        count = np.array([len(at) for _, at in held])
        every = np.concatenate([at for _, at in held])
        (a, of_a), (b, of_b) = self.ids_a.take(every), self.ids_b.take(every)
        ends_a, ends_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        # a lane takes pieces until it holds LANE tokens; it starts with its slice
        last = np.cumsum(count)
        upto = np.concatenate([[0], np.cumsum(np.maximum(of_a, of_b))])
        of_slice = np.repeat(np.arange(len(held)), count)
        number = (upto[:-1] - upto[last - count][of_slice]) // LANE
        fresh = np.ones(len(every), bool)
        fresh[1:] = (of_slice[1:] != of_slice[:-1]) | (number[1:] != number[:-1])
        starts = np.flatnonzero(fresh)
        at_a, at_b = (np.concatenate([[0], np.cumsum(n)]) for n in (of_a, of_b))
        bound = np.append(starts, len(every))
        cuts, (of_cut, link_a, link_b) = merge(at_a[bound[:-1]], at_a[bound[1:]], at_b[bound[:-1]], at_b[bound[1:]], ends_a, ends_b)
        lane_owner = owner[of_slice[starts]]
        owner_of_link = lane_owner[cuts[0][of_cut]]

        # pairs per text, with how often they are linked
        wide = len(self.len_a) * self.size_b
        place = {i: k for k, i in enumerate(dict.fromkeys(owner.tolist()))}
        slot = np.zeros(len(out), np.int64)
        slot[list(place)] = list(place.values())
        key, times = np.unique(slot[owner_of_link] * wide + a[link_a] * self.size_b + b[link_b], return_counts=True)
        split = np.searchsorted(key, np.arange(len(place) + 1) * wide)

        # the groups as text: order tokens by lane, group, side
        by_lane = np.argsort(cuts[0], kind="stable")
        fa, ta, fb, tb = (c[by_lane] for c in cuts[1:])
        codes = np.empty(len(a) + len(b), np.int64)
        group_of_a, group_of_b = np.repeat(np.arange(len(fa)), ta - fa), np.repeat(np.arange(len(fb)), tb - fb)
        mark_a, mark_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        mark_a[ta - 1], mark_b[tb - 1] = 1, 2
        codes[np.arange(len(a)) + fb[group_of_a]] = 3 * a + mark_a
        codes[np.arange(len(b)) + ta[group_of_b]] = 3 * b + mark_b
        slice_end = np.concatenate([[0], at_a[last] + at_b[last]])
        groups_in = np.bincount(lane_owner[cuts[0]], minlength=len(out))
        links_in = np.bincount(owner_of_link, minlength=len(out))
        token_a, token_b = np.concatenate([[0], at_a[last]]), np.concatenate([[0], at_b[last]])
        for k, (i, _) in enumerate(held):
            r = out[i]
            letters = self.digits[codes[slice_end[k]:slice_end[k + 1]]].ravel()
            word = letters[letters != 0].tobytes()
            if r["n_a"]:
                r["sha"].update(b";")
            r["sha"].update(word[:-1])
            r["n_a"] += int(token_a[k + 1] - token_a[k])
            r["n_b"] += int(token_b[k + 1] - token_b[k])
        for i, s in place.items():
            r, span = out[i], slice(split[s], split[s + 1])
            r["pairs"].append((key[span] - s * wide, times[span]))
            r["n_groups"] += int(groups_in[i])
            r["n_links"] += int(links_in[i])


SCHEMA = "key long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"


def align(docs: DataFrame, folder: str = FOLDER, file_a: str = FILE_A, file_b: str = FILE_B, frequent: int = FREQUENT) -> DataFrame:
    """``docs(doc_id, text)`` -> counts of tokens, groups and links per document (see the module)."""
    spark = docs.sparkSession
    files = []
    for name in (file_a, file_b):
        with open(os.path.join(folder, name), "rb") as f:
            files.append(f.read())
    sent = spark.sparkContext.broadcast(files)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = None
        lists = lambda rows, kind: pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(r) for r in rows])]), pa.int32()), pa.array(np.concatenate([*rows, np.zeros(0, np.int64)]), pa.int64()).cast(kind))
        for b in batches:
            if not b.num_rows:
                continue
            aligner = aligner or Aligner(Pair(*sent.value))
            rows = list(aligner.align(b.column("text").to_pylist()))
            pair, docs_with = np.unique(np.concatenate([r["pairs"][0] for r in rows]), return_counts=True)
            number = lambda c: pa.array([r[c] for r in rows] + [None], pa.int64())  # noqa: E731,B023
            own = lambda c: pa.concat_arrays([b.column(c), pa.nulls(1, pa.int64())])  # noqa: E731,B023
            # the last row, without a key, holds the batch's own counts of documents per pair
            yield pa.RecordBatch.from_arrays(
                [own("key"), own("doc_id"), *map(number, ("n_a", "n_b", "n_groups", "n_links")), pa.array([r["sha"] for r in rows] + [None], pa.string()),
                 lists([*[r["pairs"][0] for r in rows], pair], pa.int64()), lists([*[r["pairs"][1] for r in rows], docs_with], pa.int32())],
                names=["key", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])

    made = cut_lineage(docs.select(F.monotonically_increasing_id().alias("key"), "doc_id", "text").mapInArrow(run, SCHEMA), "aligned")
    each = lambda df, name: df.select("key", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("key", F.col("p.pairs").alias("pair"), F.col("p.times").alias(name))
    size_b = len(Pair(*files).bytes_b)
    count = cut_lineage(each(made.where("key is null"), "n").groupBy("pair").agg(F.sum("n").alias("count")), "pairs")
    highest = count.groupBy(F.expr(f"pair div {size_b}").alias("a")).agg(F.max("count").alias("highest"))  # one row per A id
    known = cut_lineage(count.join(F.broadcast(highest), F.expr(f"pair div {size_b}") == F.col("a")).select("pair", "count", (F.col("count") == F.col("highest")).alias("is_best")), "known")
    size = known.agg(F.count("*").alias("n"), F.sum("count").alias("rows")).first()
    rows = each(made.where("key is not null"), "times")
    if size.n <= frequent:
        joined = rows.join(F.broadcast(known), "pair")
    else:
        bound = size.rows / frequent  # at most ``frequent`` pairs have this count
        often = F.broadcast(known.where(F.col("count") >= bound))
        joined = rows.join(often, "pair").unionByName(rows.join(often.select("pair"), "pair", "left_anti").join(known.where(F.col("count") < bound), "pair"))
    sums = joined.groupBy("key").agg(F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return made.where("key is not null").drop("pairs", "times").join(sums, "key", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(pick(table(spark, sf_dir, "documents"), doc_id="long", text="string"))
