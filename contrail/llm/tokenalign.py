"""Alignment of two tokenizers over the same texts.

A is a byte-level BPE (``tokenizers``), encoding a space and the text; B a piece
model with byte fallback (``sentencepiece``), which adds that space itself. The
libraries' own spans are the coarse cuts: A's character offsets, carried to bytes by
the characters' UTF-8 lengths, and B's proto spans. Where they do not tell tokens
apart (several tokens inside one character of A, byte-fallback tokens of B) the
bytes that each token decodes to refine them. Places where a token of A and one of B
both end cut the tokens into groups; overlapping tokens are links.

Texts are cut where no token of either tokenizer can cross (``Cutter``: between a run
of Latin letters with the space before it and a few marks or a line end; the
vocabularies are looked up for it, and with others the text stays whole). A worker
encodes each distinct piece once (it remembers a bounded number of them), and a
text's alignment is that of its pieces in order.

``align`` encodes once and stages each row's groups and its distinct id pairs with
their number of links; the pairs are summed over all rows, and a second pass over the
pairs alone scores the rows. The summed pairs are broadcast up to ``broadcast_pairs``
of them; beyond that the rows' pairs are joined with salts.

Defined results: NULL and empty texts, and texts whose tokens do not decode to the
space and the text (such as those with U+2581), have no tokens: zeros and empty
groups, and their links are not counted. Special tokens' strings are plain text.
Repeated rows count each; pairs that tie for a B id's highest count are all best;
an empty table gives an empty result; the columns of ``keep`` stay, and those named
like the results are overwritten.
"""

from __future__ import annotations

import json
import re
import sys
import types

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from contrail.llm.common import by_value, cells, salted_join
from contrail.session import materialize, staging_path

A_PATH = "/opt/tokenizers/byte_bpe_50k.json"
B_PATH = "/opt/tokenizers/piece_bpe_32k.model"
COUNTS = ("n_a", "n_b", "n_groups", "n_links")
MADE = (*COUNTS, "n_best", "count_sum", "groups")
#: Counted pairs, 17 bytes each, that are sent to every worker.
BROADCAST_PAIRS = 2_000_000
#: Pieces that a worker remembers (twice as many at most), and the longest in characters.
REMEMBERED, LONGEST = 140_000, 64
LEARNED = 10_000
#: Rows scored at once.
SCORED_ROWS = 500
FLUSH_BYTES = 4 << 20
ROW_GROUP_BYTES = 16 << 20
B_MASK = (1 << 32) - 1
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
#: ASCII digits and marks but the apostrophe, which begins contractions.
MARKS = r"0-9.,;:!?|*#%&$()\[\]{}<>=+/\\\"@^_~-"
#: Pieces: letters with the space before them, marks with a space before and a line end behind
#: them, or whatever else stands there.
PIECES = re.compile(f" ?[{LETTERS}]+|(?: (?![{LETTERS}])|[^ {LETTERS}])+")
_ALONE = re.compile(f" ?[{LETTERS}]+| ?[{MARKS}]+\n?|\n")


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1
    as itself, the others from U+0100 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


class Cutter:
    """Cuts texts into pieces that both tokenizers encode apart.

    A's pattern begins a new word at each space before a letter or mark, between letters
    and marks, and around a single line end; apostrophes (contractions), other
    alphabets and longer white space are not cut off. B's merges join only what some
    piece of its vocabulary holds: it must hold no space behind another character, no
    letter beside a mark and no line end.
    """

    def __init__(self, a_path: str, b_pieces: list[str]):
        with open(a_path, encoding="utf-8") as f:
            rules = json.load(f)
        first = rules.get("pre_tokenizer") or {}
        joins = re.compile(f"[{LETTERS}][{MARKS}]|[{MARKS}][{LETTERS}]|\n|[^▁]▁")
        self.cuts = (rules.get("normalizer") is None and first.get("type") == "ByteLevel"
                     and first.get("use_regex") is True
                     and not any(joins.search(p) for p in b_pieces
                                 if not re.fullmatch("<.*>", p)))

    def __call__(self, text: str) -> list[str]:
        """Pieces that joined give ``text``, which begins with a space."""
        return PIECES.findall(text)

    @staticmethod
    def runs(found: list[str], odd: list[int]) -> list[tuple[int, int]]:
        """The ranges of ``found`` that stay together: each piece of ``odd``, which cannot stand
        alone, with its neighbours."""
        out: list[tuple[int, int]] = []
        for i in odd:
            low, high = max(0, i - 1), min(len(found), i + 2)
            if out and low < out[-1][1]:
                out[-1] = out[-1][0], high
            else:
                out.append((low, high))
        return out


class Aligner:
    """Both tokenizers, with the bytes of each token and the remembered pieces."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        alphabet = byte_alphabet()
        self.a_bytes = {i: bytes(alphabet[c] for c in t) if all(c in alphabet for c in t)
                        else t.encode() for t, i in self.a.get_vocab().items()}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_fallback = [self.b.is_byte(i) for i in range(len(pieces))]
        self.b_bytes = [bytes([int(p[1:-1], 16)]) if fallback else
                        p.replace("▁", " ").encode()
                        for p, fallback in zip(pieces, self.b_fallback, strict=True)]
        self.cutter = Cutter(a_path, pieces)
        self.now: dict[str, tuple] = {}
        self.before: dict[str, tuple] = {}
        self.odd: dict[str, tuple] = {}

    def a_ends(self, piece: str) -> tuple[list[int], list[int]]:
        """ids, and the byte after each token."""
        got = self.a.encode(piece, add_special_tokens=False)
        ids, spans = got.ids, got.offsets
        if piece.isascii():
            return ids, [x[1] for x in spans]
        at, upto = [0], 0
        for c in piece:
            upto += len(c.encode())
            at.append(upto)
        ends, end, starts = [], 0, [x[0] for x in spans[1:]]
        starts.append(len(piece))
        for i, (_, char_end), follows in zip(ids, spans, starts, strict=True):
            # The next token begins inside this one's last character: bytes decide.
            end = end + len(self.a_bytes[i]) if follows < char_end else at[char_end]
            ends.append(end)
        return ids, ends

    def b_ends(self, piece: str) -> tuple[list[int], list[int]]:
        """ids, and the byte after each token. The space that B adds is the piece's own, or
        stands with a line end, which no token crosses, before it."""
        lead = 0 if piece[0] == " " else 2
        ids, ends, end, fallback = [], [], 0, self.b_fallback
        text = "\n" + piece if lead else piece[1:]
        for p in self.b.encode(text, return_type="proto").pieces[lead:]:
            i = p.id
            end = end + len(self.b_bytes[i]) if fallback[i] else p.end + 1 - lead
            ids.append(i)
            ends.append(end)
        return ids, ends

    def align(self, pieces: list[str]) -> list[tuple | None]:
        """For each piece (n_a | n_b << 32 | n_groups << 64, groups, the links' pairs as bytes of
        longs), or None where the tokens do not decode to it. Pieces behind the first begin
        with a space and a letter: they are encoded together, in one call a library."""
        from array import array

        text = "".join(pieces)
        a, a_ends = self.a_ends(text)
        b, b_ends = self.b_ends(text)
        whole, a_bytes, b_bytes = text.encode(), self.a_bytes, self.b_bytes
        if (b"".join([a_bytes[i] for i in a]) != whole
                or b"".join([b_bytes[i] for i in b]) != whole):
            return [None] if len(pieces) == 1 else [x for p in pieces for x in self.align([p])]
        out, i, j, end = [], 0, 0, 0
        for piece in pieces:
            end += len(piece) if piece.isascii() else len(piece.encode())
            groups, pairs, first_a, first_b, i0, j0, y = [], array("q"), i, j, i, j, -1
            while y != end:
                pairs.append(a[i] << 32 | b[j])
                x, y = a_ends[i], b_ends[j]
                if x < y:
                    i += 1
                    y = -1
                elif x > y:
                    j += 1
                else:
                    i += 1
                    j += 1
                    if i - i0 == 1 and j - j0 == 1:
                        groups.append(f"{a[i0]}|{b[j0]}")
                    else:
                        groups.append(
                            ",".join(map(str, a[i0:i])) + "|" + ",".join(map(str, b[j0:j])))
                    i0, j0 = i, j
            out.append((i - first_a | j - first_b << 32 | len(groups) << 64, ";".join(groups),
                        pairs.tobytes()))
        return out

    def _learn(self, pieces: set[str]) -> dict[str, tuple | None]:
        """The alignments of pieces that stand alone; short ones are remembered."""
        found = {p: self.before[p] for p in pieces if p in self.before}
        words, others = [], []
        for p in pieces:
            if p not in found:
                (words if p[0] == " " and p[-1].isalpha() else others).append(p)
        if words:
            found.update(zip(words, self.align(words), strict=True))
        for p in others:
            found[p] = self.align([p])[0]
        if len(self.now) >= REMEMBERED:
            self.before, self.now = self.now, {}
        self.now.update((p, known) for p, known in found.items()
                        if known is not None and len(p) <= LONGEST)
        return found

    def _mixed(self, piece: str):
        known = self.odd.get(piece)
        if known is None:
            known = self.align([piece])[0]
            if known is not None and len(piece) <= LONGEST:
                if len(self.odd) >= REMEMBERED // 5:
                    self.odd.clear()
                self.odd[piece] = known
        return known

    def pieces(self, text: str | None) -> list[tuple]:
        """The alignments of the pieces of ``text``; [] where it has no tokens."""
        if not text:
            return []
        if not self.cutter.cuts:
            known = self.align([" " + text])[0]
            return [] if known is None else [known]
        found = self.cutter(" " + text)
        out = list(map(self.now.get, found))  # only pieces that stand alone are in it
        if None not in out:
            return out
        new = [i for i, known in enumerate(out) if known is None]
        runs = self.cutter.runs(found, [i for i in new if _ALONE.fullmatch(found[i]) is None])
        inside = {i for low, high in runs for i in range(low, high)}
        new = [i for i in new if i not in inside]
        at = 0
        while at < len(new):  # a very long text is learned in parts
            part = new[at:at + LEARNED]
            learned = self._learn({found[i] for i in part})
            for i in part:
                out[i] = learned[found[i]]
            at += LEARNED
        done, upto = [], 0
        for low, high in runs:
            done += out[upto:low]
            done.append(self._mixed("".join(found[low:high])))
            upto = high
        done += out[upto:]
        return [] if None in done else done


def _aligner(a_path: str, b_path: str) -> Aligner:
    """One for each Python worker, kept over its tasks (this module is shipped by value, anew
    for each)."""
    held = sys.modules.setdefault("contrail_llm_aligners", types.ModuleType("aligners")).__dict__
    key = f"{a_path}\n{b_path}"
    if key not in held:
        held[key] = Aligner(a_path, b_path)
    return held[key]


def _align_batches(a_path: str, b_path: str, columns: int, names: list[str]):
    """Rows of ``columns`` kept columns and the text."""

    def rows(batches):
        import numpy as np
        import pyarrow as pa

        aligner = _aligner(a_path, b_path)
        empty = np.zeros(0, np.int64)

        def flush(batch, start: int, out: list):
            part = batch.slice(start, len(out))
            sums, groups, pairs, times = zip(*out, strict=True)
            ends = pa.array(np.cumsum([0, *map(len, pairs)]), pa.int32())
            numbers = [[x & B_MASK for x in sums], [x >> 32 & B_MASK for x in sums],
                       [x >> 64 for x in sums], [int(t.sum()) for t in times]]
            return pa.RecordBatch.from_arrays([
                *(part.column(i) for i in range(columns)),
                *(pa.array(x, pa.int64()) for x in numbers), pa.array(groups, pa.string()),
                pa.ListArray.from_arrays(ends, pa.array(np.concatenate(pairs))),
                pa.ListArray.from_arrays(ends, pa.array(np.concatenate(times).astype(np.int32))),
            ], names=names)

        for batch in batches:
            start, out, size = 0, [], 0
            for no, raw in enumerate(cells(batch.column(columns))):
                found = aligner.pieces(raw.decode() if raw else None)
                if found:
                    sums, groups, links = zip(*found, strict=True)
                    text = ";".join(groups)
                    out.append((sum(sums), text, *np.unique(
                        np.frombuffer(b"".join(links), np.int64), return_counts=True)))
                    size += len(text)
                else:
                    out.append((0, "", empty, empty))
                if size > FLUSH_BYTES:
                    yield flush(batch, start, out)
                    start, out, size = no + 1, [], 0
            if out:
                yield flush(batch, start, out)

    return rows


def _sum_batches(batches):
    """pair, n: the links of each pair in a batch of rows."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        pairs, times = (np.asarray(x.flatten()) for x in batch.columns)
        keys, at = np.unique(pairs, return_inverse=True)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(
            np.bincount(at, times, len(keys)).astype(np.int64))], names=["pair", "n"])


def aligned_rows(docs: DataFrame, text_col: str = "text", a_path: str = A_PATH,
                 b_path: str = B_PATH, keep: list[str] | None = None) -> DataFrame:
    """The columns of ``keep`` (all), n_a, n_b, n_groups, n_links, groups (``a1,a2|b1;...``, ids
    in order), pairs and times: each row's distinct pairs (a_id << 32 | b_id) and their
    number of links. Staged."""
    taken = (*MADE, "pairs", "times")
    own = [c for c in (docs.columns if keep is None else keep) if c not in taken]
    schema = StructType([
        *(docs.schema[c] for c in own), *(StructField(c, LongType()) for c in COUNTS),
        StructField("groups", StringType()), StructField("pairs", ArrayType(LongType())),
        StructField("times", ArrayType(IntegerType()))])
    work = docs.select(*(F.col(f"`{c}`") for c in own), F.col(f"`{text_col}`").alias("__text"))
    path = staging_path(docs.sparkSession, "aligned")
    # Small row groups: a writer holds one of each column in memory, beside the worker's pieces.
    work.mapInArrow(_align_batches(a_path, b_path, len(own), schema.names), schema).write.option(
        "parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def link_counts(rows: DataFrame) -> DataFrame:
    """pair, a_id, b_id, n (links of the pair over all rows), best (n is the highest of its
    b_id), of staged ``aligned_rows``. Staged."""
    counts = materialize(rows.select("pairs", "times").mapInArrow(
        _sum_batches, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")),
        "link-counts").withColumn("b_id", F.col("pair").bitwiseAND(F.lit(B_MASK)).cast("int"))
    most = counts.groupBy("b_id").agg(F.max("n").alias("most"))
    return materialize(counts.join(most, "b_id").select(
        "pair", F.shiftright("pair", 32).cast("int").alias("a_id"), "b_id", "n",
        (F.col("n") == F.col("most")).alias("best")), "links")


def _score_udf(shared):
    def score(pairs, times):
        import numpy as np
        import pyarrow as pa

        keys, counts, best = shared.value
        n_best, total = (np.zeros(len(pairs), np.int64) for _ in range(2))
        for start in range(0, len(pairs), SCORED_ROWS):
            own = pairs.slice(start, SCORED_ROWS)
            ends = np.concatenate([[0], np.cumsum(np.asarray(own.value_lengths()))])
            n = np.asarray(times.slice(start, SCORED_ROWS).flatten()).astype(np.int64)
            at = np.searchsorted(keys, np.asarray(own.flatten()))
            for out, value in ((n_best, best), (total, counts)):
                sums = np.concatenate([[0], np.cumsum(n * value[at])])
                out[start:start + len(own)] = sums[ends[1:]] - sums[ends[:-1]]
        return pa.StructArray.from_arrays([pa.array(n_best), pa.array(total)],
                                          ["n_best", "count_sum"])

    return arrow_udf(score, "n_best bigint, count_sum bigint")


def score_rows(rows: DataFrame, links: DataFrame,
               broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """``rows`` (with pairs and times) with n_best and count_sum in their place. ``rows`` may be a
    projection of the staged ``aligned_rows``: what it leaves out is not carried past Python."""
    own = [F.col(f"`{c}`") for c in rows.columns if c not in (
        "pairs", "times", "n_best", "count_sum")]
    if links.count() <= broadcast_pairs:
        import numpy as np

        got = links.select("pair", "n", "best").toArrow()
        pairs, n, best = (np.asarray(got[c]) for c in ("pair", "n", "best"))
        order = np.argsort(pairs)
        shared = rows.sparkSession.sparkContext.broadcast((pairs[order], n[order], best[order]))
        scored = rows.withColumn("__s", _score_udf(shared)("pairs", "times"))
        return scored.select(*own, F.col("__s")["n_best"].alias("n_best"),
                             F.col("__s")["count_sum"].alias("count_sum"))
    # File and place in it name a row of the staged table in every attempt.
    uid = F.struct(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    each = rows.select(uid.alias("__uid"), F.inline(F.arrays_zip("pairs", "times"))).select(
        "__uid", F.col("pairs").alias("pair"), "times")
    sums = salted_join(each, links.select("pair", "n", "best"), ["pair"], ["__uid"]).groupBy(
        "__uid").agg(F.sum(F.col("times") * F.col("best").cast("int")).alias("__b"),
                     F.sum(F.col("times") * F.col("n")).alias("__n"))
    return rows.withColumn("__uid", uid).join(sums, "__uid", "left").select(
        *own, F.coalesce("__b", F.lit(0)).cast("bigint").alias("n_best"),
        F.coalesce("__n", F.lit(0)).cast("bigint").alias("count_sum"))


def align(docs: DataFrame, text_col: str = "text", a_path: str = A_PATH, b_path: str = B_PATH,
          keep: list[str] | None = None, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """The columns of ``keep`` (all) with n_a, n_b, n_groups, n_links, n_best, count_sum and
    groups."""
    rows = aligned_rows(docs, text_col, a_path, b_path, keep)
    own = [c for c in rows.columns if c not in (*MADE, "pairs", "times")]
    scored = score_rows(rows, link_counts(rows), broadcast_pairs)
    return scored.select(*(F.col(f"`{c}`") for c in own), *MADE)


def alignment_report(docs: DataFrame, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """The op13 query's rows: the groups' hash is taken before the links are scored."""
    rows = aligned_rows(docs, keep=["doc_id"])
    hashed = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    scored = score_rows(rows.withColumn("groups_sha256", hashed).drop("groups"), link_counts(rows),
                        broadcast_pairs)
    return scored.select("doc_id", *MADE[:-1], "groups_sha256")


by_value(__name__)
