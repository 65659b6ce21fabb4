"""The VCF data source: byte ranges, block gzip, per-allele values, alignment, pushed filters."""

import gzip
import random
import struct
import zlib

import pytest

from genoframe.sources import vcf_source as vs

HEAD = """##fileformat=VCFv4.2
##INFO=<ID=AF,Number=A,Type=Float,Description="f">
##INFO=<ID=AD,Number=R,Type=Integer,Description="d">
##INFO=<ID=DP,Number=1,Type=Integer,Description="d">
##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">
##FORMAT=<ID=PL,Number=G,Type=Integer,Description="pl">
##FORMAT=<ID=AD,Number=R,Type=Integer,Description="ad">
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\tS2\tS3
"""
RECORD = "1\t100\trs1\tA\tC,G\t50\tPASS\tAF=0.1,0.2;AD=9,5,4;DP=18;DB\tGT:AD:PL\t1/2:1,2,3:10,11,12,13,14,15\t2|2:0,0,9:.\t./1:1,1,0:1,2,3,4,5,6\n"


def bgzf(data: bytes, size: int) -> bytes:
    """``data`` as BGZF blocks of ``size`` bytes of text, closed by the empty block."""
    out = b""
    for i in [*range(0, len(data), size), len(data)]:
        c = zlib.compressobj(6, zlib.DEFLATED, -15)
        part = data[i:i + size]
        body = c.compress(part) + c.flush()
        out += (b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff\x06\x00BC\x02\x00" + struct.pack("<H", len(body) + 25)
                + body + struct.pack("<II", zlib.crc32(part), len(part)))
    return out


def rows(df):
    return sorted(tuple(str(x) for x in r) for r in df.collect())


def many(n=300):
    rnd = random.Random(5)
    out = HEAD
    for i in range(n):
        gts = [rnd.choice(["0/0", "0/1", "1|1", "./.", "1/2", "2/2", "0/2"]) for _ in range(3)]
        out += f"{1 + i % 3}\t{100 + i}\tv{i}\tA\tC,G\t.\tPASS\t{'X' * rnd.randrange(60)}\tGT\t" + "\t".join(gts) + "\n"
    return out


def test_calls_and_values_of_each_allele(spark, tmp_path):
    (tmp_path / "a.vcf").write_text(HEAD + RECORD)
    g = vs.read_alleles(spark, str(tmp_path / "a.vcf"), formats="AD,PL")
    got = {(r.alt, r.sample_id): (r.gt, r.dosage, r.phased, r.format) for r in g.collect()}
    assert got == {
        ("C", "S1"): ("1/0", 1, False, {"AD": "1,2", "PL": "10,11,12"}),
        ("G", "S1"): ("0/1", 1, False, {"AD": "1,3", "PL": "10,13,15"}),
        ("G", "S2"): ("1|1", 2, True, {"AD": "0,9", "PL": "."}),
        ("C", "S3"): ("./1", None, False, {"AD": "1,1", "PL": "1,2,3"}),
        ("G", "S3"): ("./0", None, False, {"AD": "1,0", "PL": "1,4,6"})}
    v = {r.alt: r for r in vs.read_alleles(spark, str(tmp_path / "a.vcf"), rows="variants").collect()}
    assert v["C"].info == {"AF": "0.1", "AD": "9,5", "DP": "18", "DB": None}
    assert v["G"].info == {"AF": "0.2", "AD": "9,4", "DP": "18", "DB": None} and v["G"].allele == 2 and v["G"].qual == 50.0


@pytest.mark.parametrize("split", [1, 7, 97, 400, 5000])
def test_every_line_is_owned_by_one_range(tmp_path, split):
    text = many().encode()
    want = text.rstrip(b"\n").split(b"\n")
    for name, data in [("p", text), ("no_end", text[:-1]), ("b", bgzf(text, 150)), ("line_blocks", bgzf(text, len(HEAD))),
                       ("g", gzip.compress(text[:900]) + gzip.compress(text[900:]))]:
        path = tmp_path / name
        path.write_bytes(data)
        size = len(data)
        got = []
        with open(path, "rb") as f:
            for a in range(0, size, split):
                got += [x for x in vs.lines_of(f, a, min(a + split, size)) if x]
        assert got == want, name


def test_ranges_in_spark_give_the_whole_file(spark, tmp_path):
    text = many()
    (tmp_path / "whole.vcf").write_text(text)
    (tmp_path / "blocks.vcf.gz").write_bytes(bgzf(text.encode(), 700))
    whole = rows(vs.read_alleles(spark, str(tmp_path / "whole.vcf")))
    parts = vs.read_alleles(spark, str(tmp_path / "whole.vcf"), split_bytes=2000)
    assert parts.rdd.getNumPartitions() > 3 and rows(parts) == whole
    assert rows(vs.read_alleles(spark, str(tmp_path / "blocks.vcf.gz"), split_bytes=500)) == whole
    assert sum(1 for r in whole) > 300


def test_filters_reach_the_reader(spark, tmp_path):
    (tmp_path / "w.vcf").write_text(many())
    g = vs.read_alleles(spark, str(tmp_path / "w.vcf"))
    want = sorted(tuple(str(x) for x in r) for r in g.collect() if r.chrom == "2" and 150 <= r.pos < 200)
    part = g.where("chrom = '2' and pos >= 150 and pos < 200")
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "150" not in plan.split("BatchScan")[0], plan
    assert rows(part) == want and want
    reader = vs.VcfReader({"path": str(tmp_path / "w.vcf")})
    assert list(reader.pushFilters([vs.EqualTo(("chrom",), "2"), vs.GreaterThan(("pos",), 149), vs.LessThan(("pos",), 200)])) == []
    assert (reader.chroms, reader.low, reader.high) == ({"2"}, 150, 199)


def write_fasta(path, contigs, width=11):
    text, fai = "", ""
    for name, seq in contigs.items():
        text += f">{name}\n"
        fai += f"{name}\t{len(seq)}\t{len(text)}\t{width}\t{width + 1}\n"
        text += "".join(seq[i:i + width] + "\n" for i in range(0, len(seq), width))
    path.write_text(text)
    (path.parent / (path.name + ".fai")).write_text(fai)


def leftmost(seq, pos, ref, alt):
    """Brute force: the shortest and leftmost record with the same changed sequence."""
    changed = seq[:pos - 1] + alt + seq[pos - 1 + len(ref):]
    delta = len(alt) - len(ref)
    for n in range(1, len(seq) + 1):            # length of ref
        for p in range(1, len(seq) - n + 2):
            m = n + delta
            if m >= 1 and seq[:p - 1] == changed[:p - 1] and seq[p - 1 + n:] == changed[p - 1 + m:] and \
                    (n == 1 or m == 1 or seq[p - 1] != changed[p - 1]):
                return p, seq[p - 1:p - 1 + n], changed[p - 1:p - 1 + m]


def test_alleles_are_aligned_to_the_leftmost_place(tmp_path):
    rnd = random.Random(2)
    for trial in range(150):
        seq = "".join(rnd.choice("AC") for _ in range(40))
        write_fasta(tmp_path / "r.fa", {"1": "GGG" + seq, "2": seq})
        ref = vs.Reference(str(tmp_path / "r.fa"))
        assert ref.fetch("chr2", 3, 25) == seq[2:25]
        pos, n = rnd.randrange(10, 30), rnd.randrange(1, 6)
        r = seq[pos - 1:pos - 1 + n]
        a = r[0] + "".join(rnd.choice("AC") for _ in range(rnd.randrange(0, 5)))
        if len(a) != len(r):
            got = vs.normalised("2", pos, r, a, ref)
            want = leftmost(seq, pos, r, a)
            # an indel that can slide to the first base of its contig stays as given
            assert got == want or got[0] == pos and want[0] <= 2, (seq, pos, r, a, got, want)


def test_a_long_homopolymer_is_crossed(tmp_path):
    write_fasta(tmp_path / "r.fa", {"chr7": "CG" + "A" * 3000 + "T"}, width=60)
    ref = vs.Reference(str(tmp_path / "r.fa"))
    assert vs.normalised("7", 3000, "AA", "A", ref) == (2, "GA", "G")
    assert vs.normalised("9", 3000, "AAT", "AT", ref) == (3000, "AA", "A")      # contig missing: trimmed only
    assert vs.normalised("7", 5, "A", "<DEL>", ref) == (5, "A", "<DEL>")


def test_duplicate_records_merge(spark, tmp_path):
    (tmp_path / "r.fa").parent.mkdir(exist_ok=True)
    write_fasta(tmp_path / "r.fa", {"1": "G" + "CACACACACA" + "T" * 20})
    line = "1\t{}\t.\t{}\t{}\t.\tPASS\t.\tGT\t{}\t0/0\t0/0\n"
    (tmp_path / "d.vcf").write_text(HEAD + line.format(3, "ACA", "A", "0/1") + line.format(7, "ACA", "A", "1/1") + line.format(9, "ACA", "A", "./."))
    got = vs.merge_calls(vs.read_alleles(spark, str(tmp_path / "d.vcf"), reference=str(tmp_path / "r.fa"))).collect()
    assert [(r.pos, r.ref, r.alt, r.sample_id, r.gt, r.dosage) for r in got] == [(1, "GCA", "G", "S1", "1/1", 2)]


def test_empty_folder_and_missing_header(spark, tmp_path):
    (tmp_path / "none").mkdir()
    assert vs.read_alleles(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "sample=Z9").mkdir()
    (tmp_path / "sample=Z9" / "part.txt").write_text("1\t5\t.\tA\tT\t.\tPASS\t.\tGT\t0/1\n")
    got = vs.read_alleles(spark, str(tmp_path / "sample=*"), sample_from_path=True).collect()
    assert [(r.sample_id, r.dosage) for r in got] == [("Z9", 1)]
    with pytest.raises(Exception, match="no header"):
        vs.read_alleles(spark, str(tmp_path / "sample=*")).collect()
