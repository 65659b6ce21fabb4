"""VCF files as a Spark data source: byte-range partitions, alleles split and aligned while reading.

``spark.read.format("vcf_alleles")`` gives one row per ALT allele of a record (``rows=variants``) or
one row per sample that carries or misses the allele (``rows=genotypes``; hom-ref is implied).

* A file is cut into byte ranges of ``split_bytes``. Plain text and block-gzip (BGZF) members are read
  from any offset; a file in one gzip stream is read by its first range alone.
* A range reads the header of its own file, so no header passes through the driver or a join.
* Comparisons of ``chrom`` and ``pos`` are pushed into the reader: other lines are dropped before their
  sample columns are split.
* A call is recoded for the allele of its row (other alternative alleles count as reference, any missing
  haplotype makes the dosage NULL). INFO and FORMAT values that the header declares per allele are
  indexed: Number=A gives the allele's value, R the pair ref,allele, G the genotypes of that pair.
* With ``reference`` (FASTA beside its .fai index) alleles are left-aligned; without it they are trimmed.
  Symbolic and spanning alleles, and records on contigs the index lacks, keep their coordinates.

Options: rows, split_bytes, info, formats (comma lists; default: all INFO, no FORMAT but GT), reference,
sample_from_path (the file name names the one sample, as ``.../sample=<id>/`` or ``<id>.vcf``).
"""

from __future__ import annotations

import fnmatch
import glob
import os
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In,
                                    InputPartition, LessThan, LessThanOrEqual)

from genoframe.operators.normalize import shift_left, trim

FORMAT_NAME = "vcf_alleles"
VARIANT_SCHEMA = ("chrom string, pos bigint, id string, ref string, alt string, qual double, filter string, "
                  "info map<string,string>, allele int, file string")
GENOTYPE_SCHEMA = ("chrom string, pos bigint, ref string, alt string, filter string, sample_id string, gt string, "
                   "dosage int, phased boolean, format map<string,string>")
_TEXT_MAP = pa.map_(pa.string(), pa.string())
_ARROW = {
    "variants": pa.schema([("chrom", pa.string()), ("pos", pa.int64()), ("id", pa.string()), ("ref", pa.string()),
                           ("alt", pa.string()), ("qual", pa.float64()), ("filter", pa.string()), ("info", _TEXT_MAP),
                           ("allele", pa.int32()), ("file", pa.string())]),
    "genotypes": pa.schema([("chrom", pa.string()), ("pos", pa.int64()), ("ref", pa.string()), ("alt", pa.string()),
                            ("filter", pa.string()), ("sample_id", pa.string()), ("gt", pa.string()),
                            ("dosage", pa.int32()), ("phased", pa.bool_()), ("format", _TEXT_MAP)]),
}
SPLIT_BYTES = 64 << 20
BATCH_ROWS = 10_000
READ_BYTES = 1 << 20
#: The first bytes of a BGZF block, and its extra field (fixed values of the format).
BGZF_MAGIC = b"\x1f\x8b\x08\x04"
BGZF_FIELD = b"BC\x02\x00"
BGZF_HEAD = 18


# ------------------------------------------------------------------ files

def _is_local(path: str) -> bool:
    return "://" not in path and not path.startswith("file:")


def _open(path: str):
    if path.startswith("file:"):
        path = re.sub(r"^file:/*", "/", path)
    if _is_local(path):
        return open(path, "rb")
    from pyarrow import fs
    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


def _hidden(path: str) -> bool:
    return os.path.basename(path).startswith(("_", "."))


def list_files(path: str) -> list[tuple[str, int]]:
    """(file, bytes) of a file, folder or glob pattern; hidden files are left out."""
    if path.startswith("file:"):
        path = re.sub(r"^file:/*", "/", path)
    if _is_local(path):
        found = sorted(glob.glob(path))
        files = [f for p in found for f in (sorted(glob.glob(os.path.join(p, "*"))) if os.path.isdir(p) else [p])]
        return [(f, os.path.getsize(f)) for f in files if os.path.isfile(f) and not _hidden(f)]
    from pyarrow import fs
    system, inner = fs.FileSystem.from_uri(path)
    head = re.split(r"[*?\[]", inner)[0]
    if head == inner:
        info = system.get_file_info(inner)
        infos = system.get_file_info(fs.FileSelector(inner)) if info.type == fs.FileType.Directory else [info]
        keep = [i for i in infos if i.type == fs.FileType.File]
    else:
        base = head.rsplit("/", 1)[0]
        keep = [i for i in system.get_file_info(fs.FileSelector(base, recursive=True))
                if i.type == fs.FileType.File and fnmatch.fnmatchcase(i.path, inner)]
    prefix = path[:len(path) - len(inner)]
    return sorted((prefix + i.path, i.size) for i in keep if not _hidden(i.path))


# ------------------------------------------------------------------ blocks and lines

def _plain_blocks(f, start: int, end: int):
    """(offset, bytes) from ``start`` to the end of the file, one block ending exactly at ``end``."""
    f.seek(start)
    at = start
    while True:
        data = f.read(min(READ_BYTES, end - at) if at < end else READ_BYTES)
        if not data:
            return
        yield at, data
        at += len(data)


def _gzip_blocks(f):
    """The text of one gzip file (any number of members), every block at offset 0."""
    f.seek(0)
    z = zlib.decompressobj(31)
    while True:
        data = f.read(READ_BYTES)
        if not data:
            return
        while data:
            yield 0, z.decompress(data)
            data = z.unused_data
            if z.eof:
                z = zlib.decompressobj(31)


def _block_size(head: bytes) -> int | None:
    if len(head) < BGZF_HEAD or head[:4] != BGZF_MAGIC or head[12:16] != BGZF_FIELD:
        return None
    return int.from_bytes(head[16:18], "little") + 1


def _first_block(f, start: int) -> int | None:
    """Offset of the first BGZF block at or after ``start``: one whose successor is a block or the end."""
    if start == 0:
        return 0
    f.seek(start)
    buf = f.read(3 << 16)               # a block has at most 64 KiB, so a block start and its successor lie in here
    at = buf.find(BGZF_MAGIC)
    while at >= 0:
        n = _block_size(buf[at:at + BGZF_HEAD])
        if n is not None:
            after = buf[at + n:at + n + BGZF_HEAD]
            if not after or _block_size(after) is not None:
                return start + at
        at = buf.find(BGZF_MAGIC, at + 1)
    return None


def _bgzf_blocks(f, start: int):
    at = _first_block(f, start)
    if at is None:
        return
    f.seek(at)
    buf = b""
    while True:
        if len(buf) < 1 << 16:
            buf += f.read(READ_BYTES)
        if not buf:
            return
        n = _block_size(buf[:BGZF_HEAD])
        if n is None or len(buf) < n:
            raise ValueError(f"broken block at byte {at} of a block-gzip file")
        yield at, zlib.decompress(buf[BGZF_HEAD:n - 8], -15)
        at += n
        buf = buf[n:]


def _blocks(f, start: int, end: int):
    f.seek(0)
    head = f.read(BGZF_HEAD)
    if _block_size(head) is not None:
        return _bgzf_blocks(f, start)
    if head[:2] == b"\x1f\x8b":
        return _gzip_blocks(f) if start == 0 else iter(())
    return _plain_blocks(f, start, end)


def lines_of(f, start: int, end: int) -> Iterator[bytes]:
    """The lines a byte range owns: those that begin after ``start`` (or at 0) and not after ``end``."""
    tail, drop = b"", start > 0
    for at, data in _blocks(f, start, end):
        if at >= end:
            cut = data.find(b"\n")
            if cut < 0:
                tail += data
                continue
            if not drop:
                yield tail + data[:cut]
            return
        parts = (tail + data).split(b"\n")
        tail = parts.pop()
        if drop and parts:
            del parts[0]
            drop = False
        yield from parts
    if tail and not drop:
        yield tail


class Header:
    """Sample names and the Number of INFO and FORMAT fields, from the head of a file."""

    def __init__(self, f, size: int):
        self.samples: list[str] | None = None
        self.number: dict[tuple[str, str], str] = {}
        for line in lines_of(f, 0, size):
            if not line.startswith(b"#"):
                break
            text = line.decode().rstrip("\r")
            m = re.match(r"##(INFO|FORMAT)=<ID=([^,>]+),Number=([^,>]+)", text)
            if m:
                self.number[m[1], m[2]] = m[3]
            elif text.startswith("#CHROM"):
                self.samples = text.split("\t")[9:]
                break


class Reference:
    """Bases of an indexed FASTA file, read by offset."""

    def __init__(self, path: str):
        self.index = {}
        with _open(path + ".fai") as f:
            for row in f.read().decode().splitlines():
                name, length, offset, bases, width = row.split("\t")[:5]
                self.index[name] = (int(length), int(offset), int(bases), int(width))
        self.file = _open(path)

    def entry(self, chrom: str):
        return self.index.get(chrom) or self.index.get(f"chr{chrom}") or self.index.get(re.sub("^chr", "", chrom))

    def fetch(self, chrom: str, first: int, last: int) -> str:
        """Bases first..last (1-based, both included)."""
        _, offset, bases, width = self.entry(chrom)
        a, b = (offset + (p // bases) * width + p % bases for p in (first - 1, last - 1))
        self.file.seek(a)
        return self.file.read(b - a + 1).decode().replace("\n", "").replace("\r", "").upper()


_BASES = re.compile(r"[ACGTN]+\Z", re.I)


def normalised(chrom: str, pos: int, ref: str, alt: str, reference: Reference | None) -> tuple[int, str, str]:
    """Left-aligned and trimmed allele; only trimmed where there are no reference bases."""
    if len(ref) == len(alt) == 1 or ref == alt or not (_BASES.match(ref) and _BASES.match(alt)):
        return pos, ref, alt
    ref, alt = ref.upper(), alt.upper()
    entry = reference.entry(chrom) if reference else None
    if entry is not None and pos <= entry[0]:
        p, r, a, reach = pos, ref, alt, 256
        while True:
            lo = max(1, p - reach)
            p, r, a, more = shift_left(p, r, a, reference.fetch(chrom, lo, p), lo)
            if not more:
                return trim(p, r, a)
            if p == 1:                  # an indel that reaches the first base of the contig stays as given
                break
            reach *= 4
    while min(len(ref), len(alt)) > 1 and ref[-1] == alt[-1]:
        ref, alt = ref[:-1], alt[:-1]
    return trim(pos, ref, alt)


# ------------------------------------------------------------------ records

def _of_allele(value: str, number: str | None, i: int, n_alt: int, haploid: bool = False) -> str:
    """The part of a comma list that concerns allele ``i`` (1-based) of ``n_alt``."""
    if number not in ("A", "R", "G") or value in (".", ""):
        return value
    parts = value.split(",")
    if number == "A":
        at = [i - 1]
    elif number == "R" or (haploid and len(parts) == n_alt + 1):
        at = [0, i]
    else:
        at = [0, i * (i + 1) // 2, i * (i + 3) // 2]
    return ",".join(parts[k] if k < len(parts) else "." for k in at)


def _call(gt: str, i: int) -> tuple[str, int | None, bool]:
    """A call seen from allele ``i``: its text, dosage (None: some haplotype is missing) and phase."""
    phased = "|" in gt
    alleles = gt.replace("|", "/").split("/")
    mine = ["." if not a.isdigit() else "1" if int(a) == i else "0" for a in alleles]
    return ("|" if phased else "/").join(mine), None if "." in mine else mine.count("1"), phased


class _Range(InputPartition):
    def __init__(self, path: str, start: int, end: int, size: int):
        super().__init__((path, start, end, size))
        self.path, self.start, self.end, self.size = path, start, end, size


class VcfReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.rows = options.get("rows", "genotypes")
        if self.rows not in _ARROW:
            raise ValueError("rows is 'variants' or 'genotypes'")
        self.split = max(1, int(options.get("split_bytes", SPLIT_BYTES)))
        self.info = options["info"].split(",") if options.get("info") else None
        self.formats = [x for x in options.get("formats", "").split(",") if x and x != "GT"]
        self.reference = options.get("reference")
        self.from_path = str(options.get("sample_from_path", "false")).lower() == "true"
        self.chroms: set | None = None
        self.low, self.high = None, None

    def pushFilters(self, filters):
        for f in filters:
            column, value = f.attribute, getattr(f, "value", None)
            if column == ("chrom",) and isinstance(f, (EqualTo, In)):
                wanted = {value} if isinstance(f, EqualTo) else set(value)
                self.chroms = wanted if self.chroms is None else self.chroms & wanted
            elif column == ("pos",) and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                low = value + 1 if isinstance(f, GreaterThan) else value if isinstance(f, (EqualTo, GreaterThanOrEqual)) else None
                high = value - 1 if isinstance(f, LessThan) else value if isinstance(f, (EqualTo, LessThanOrEqual)) else None
                if low is not None:
                    self.low = low if self.low is None else max(self.low, low)
                if high is not None:
                    self.high = high if self.high is None else min(self.high, high)
            else:
                yield f

    def partitions(self):
        got = [_Range(p, a, min(a + self.split, size), size) for p, size in list_files(self.path)
               for a in range(0, max(size, 1), self.split)]
        return got or [_Range("", 0, 0, 0)]

    def _name_from_path(self, path: str) -> str:
        folder = re.search(r"sample=([^/]+)/", path)
        return folder[1] if folder else re.sub(r"\.(vcf|txt)(\.gz|\.bgz)?$", "", os.path.basename(path))

    def _records(self, part, header: Header, f):
        """(fields of a line up to FORMAT, rest of the line, normalised alleles) that pass the pushed filters."""
        reference = Reference(self.reference) if self.reference else None
        n = 9 if self.rows == "genotypes" else 8
        for line in lines_of(f, part.start, part.end):
            if not line or line.startswith(b"#"):
                continue
            cut = line.find(b"\t")
            if self.chroms is not None and line[:cut].decode() not in self.chroms:
                continue
            head = line.decode().rstrip("\r").split("\t", n)
            pos, ref = int(head[1]), head[3]
            # alignment moves left by any distance, trimming moves right by less than the allele
            if self.low is not None and pos + len(ref) < self.low or \
                    self.high is not None and reference is None and pos > self.high:
                continue
            alleles = []
            for i, alt in enumerate(head[4].split(","), start=1):
                p, r, a = normalised(head[0], pos, ref, alt, reference)
                if (self.low is None or p >= self.low) and (self.high is None or p <= self.high):
                    alleles.append((i, p, r, a))
            if alleles:
                yield head, alleles, len(head[4].split(","))

    def _variants(self, part, header, f):
        for head, alleles, n_alt in self._records(part, header, f):
            info = [] if head[7] in (".", "") else [x.partition("=") for x in head[7].split(";")]
            keep = [(k, v if eq else None) for k, eq, v in info if self.info is None or k in self.info]
            qual = None if head[5] == "." else float(head[5])
            for i, p, r, a in alleles:
                own = {k: v if v is None else _of_allele(v, header.number.get(("INFO", k)), i, n_alt) for k, v in keep}
                yield head[0], p, head[2], r, a, qual, head[6], list(own.items()), i, part.path

    def _genotypes(self, part, header, f):
        names = [self._name_from_path(part.path)] if self.from_path else header.samples
        for head, alleles, n_alt in self._records(part, header, f):
            if len(head) < 10 or head[4] == ".":
                continue
            if names is None:
                raise ValueError(f"{part.path} has sample columns but no header; set sample_from_path for single-sample files")
            keys = head[8].split(":")
            if "GT" not in keys:
                continue
            at = keys.index("GT")
            wanted = [(k, keys.index(k)) for k in self.formats if k in keys]
            for name, cell in zip(names, head[9].split("\t")):
                values = cell.split(":")
                gt = values[at] if at < len(values) else "."
                if gt in ("0/0", "0|0", "0"):
                    continue
                for i, p, r, a in alleles:
                    text, dose, phased = _call(gt, i)
                    if dose == 0:
                        continue
                    haploid = "/" not in text and "|" not in text
                    own = [(k, _of_allele(values[j], header.number.get(("FORMAT", k)), i, n_alt, haploid))
                           for k, j in wanted if j < len(values)]
                    yield head[0], p, r, a, head[6], name, text, dose, phased, own

    def read(self, part):
        if not part.path:
            return
        schema = _ARROW[self.rows]
        with _open(part.path) as f:
            header = Header(f, part.size)
            rows = (self._variants if self.rows == "variants" else self._genotypes)(part, header, f)
            batch = []
            for row in rows:
                batch.append(row)
                if len(batch) >= BATCH_ROWS:
                    yield _batch(batch, schema)
                    batch = []
            if batch:
                yield _batch(batch, schema)


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


class VcfAlleles(DataSource):
    @classmethod
    def name(cls):
        return FORMAT_NAME

    def schema(self):
        return VARIANT_SCHEMA if self.options.get("rows") == "variants" else GENOTYPE_SCHEMA

    def reader(self, schema):
        return VcfReader(dict(self.options))


def read_alleles(spark: SparkSession, path: str, rows: str = "genotypes", **options) -> DataFrame:
    """The data source as a DataFrame; ``options`` as in the module's text."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(VcfAlleles)
    r = spark.read.format(FORMAT_NAME).option("rows", rows)
    for k, v in options.items():
        if v is not None:
            r = r.option(k, ",".join(v) if isinstance(v, (list, tuple)) else str(v))
    return r.load(path)


def merge_calls(genotypes: DataFrame) -> DataFrame:
    """One row per allele and sample: records that became equal by splitting and aligning are merged.

    The highest dosage stays (as ``dosage`` and ``gt``); a missing call gives way to a known one."""
    best = F.max(F.struct(F.coalesce("dosage", F.lit(-1)).alias("d"), F.col("gt"), F.col("dosage")))
    return (genotypes.groupBy("chrom", "pos", "ref", "alt", "sample_id").agg(best.alias("b"))
            .select("chrom", "pos", "ref", "alt", "sample_id", "b.gt", "b.dosage"))
