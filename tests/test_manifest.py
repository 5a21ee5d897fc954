"""Manifest scan (both forms in one pass), normalise, validate, filter, expected files."""

from pyspark.sql import functions as F

from helixframe.operators import manifest as M
from helixframe.sources.manifest import scan_manifest

# Invented rows in the two shipped layouts: a comma form and a tab form (commas inside values,
# blank columns, an ISO timestamp release date, no final newline).
COMMA = ("Assay_Type,AvgSpotLen,Center_Name,InsertSize,LibraryLayout,MBases,MBytes,Platform,ReleaseDate,Run,"
         "SRA_Sample,SRA_Study,dev_stage\n"
         "WGS,100,SOME LAB,0,SINGLE,5000,3500,ILLUMINA,2011-10-12,ERR000001,ERS000001,ERP000001,missing\n"
         "WGS,100,SOME LAB,0,SINGLE,2300,1500,ILLUMINA,2011-10-12,ERR000002,ERS000001,ERP000001,missing\n")
TAB = ("AvgSpotLen\tDATASTORE_provider\tLibraryLayout\tMBases\tRun\tSRA_Sample\tPlatform\tReleaseDate\tSRA_Study\n"
       "152\tgs,ncbi,s3\tPAIRED\t\tERR000010\tERS000002\tILLUMINA\t2014-07-17T00:00:00Z\tERP000002\n"
       "98\tgs,ncbi\tSINGLE\t\tERR000011\tERS000002\tLS454\t2014-07-17T00:00:00Z\tERP000003\n"
       "98\tgs,ncbi\t\t\tERR000012\tERS000002\tLS454\t2014-07-17T00:00:00Z\tERP000003")


def _files(tmp_path):
    (tmp_path / "a.csv").write_text(COMMA)
    (tmp_path / "b.csv").write_text(TAB)
    return [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]


def test_two_forms_one_scan(spark, tmp_path):
    df = M.normalise_manifest(scan_manifest(spark, _files(tmp_path)))
    rows = {r.run_id: r for r in df.collect()}
    assert len(rows) == 5
    assert rows["ERR000001"].sample_id == "ERS000001" and rows["ERR000001"].mbases == 5000
    assert rows["ERR000010"].attrs["DATASTORE_provider"] == "gs,ncbi,s3"
    assert rows["ERR000010"].mbases is None and rows["ERR000010"].layout == "PAIRED"
    assert rows["ERR000011"].release_ts is not None and rows["ERR000001"].release_ts is not None
    assert rows["ERR000002"].raw.startswith("WGS,100,SOME LAB")
    assert len({r.manifest_row for r in rows.values()}) == 5


def test_validate_filter_expected(spark, tmp_path):
    df = M.normalise_manifest(scan_manifest(spark, _files(tmp_path)))
    good, bad = M.validate_manifest(df)
    assert good.count() == 4 and [r.reasons for r in bad.collect()] == [["missing:layout"]]
    kept = M.filter_samples(good, include="ERS000001,ERS000002", skip=["ERS000001"])
    assert sorted(r.run_id for r in kept.collect()) == ["ERR000010", "ERR000011"]
    big = M.filter_samples(good, include=[f"X{i}" for i in range(2000)] + ["ERS000002"])
    assert big.count() == 2
    e = M.expected_files(good, "gs://bucket").where(F.col("run_id") == "ERR000010").first()
    assert [f.uri for f in e.files] == ["gs://bucket/fastq/ERP000002/ERS000002/ERR000010_1.fastq",
                                        "gs://bucket/fastq/ERP000002/ERS000002/ERR000010_2.fastq"]
    assert e.dir == "fastq/ERP000002/ERS000002/"


def test_group_by_sample_and_references(spark, tmp_path):
    df = M.expected_files(M.normalise_manifest(scan_manifest(spark, _files(tmp_path))).where("layout IS NOT NULL"))
    g = {r.sample_id: r for r in M.group_by_sample(df, with_files=True).collect()}
    assert g["ERS000001"].n_runs == 2 and g["ERS000002"].n_files == 3
    js = spark.createDataFrame([('[{"name":"a","fastaUri":"gs://r/a.fa","indexUri":"gs://r/a.fa.fai"},'
                                 '{"name":"b","fastaUri":"gs://r/b.fa","indexUri":"gs://r/b.fa.fai"}]',)], "json string")
    refs = M.filter_references(M.references_from_json(js), ["b"]).collect()
    assert [(r.name, r.fasta_uri) for r in refs] == [("b", "gs://r/b.fa")]
    assert M.select_references(spark, ["x"], "gs://r/").first().index_uri == "gs://r/x/x.fa.fai"


def test_wide_quoted_and_headerless_files(spark, tmp_path):
    head = ",".join(f"c{i}" for i in range(140)) + ",Run,SRA_Sample,SRA_Study,LibraryLayout,Platform,c0"
    row = ",".join('"a,""b"""' for _ in range(140)) + ",R1,S1,P1,PAIRED,ILLUMINA,again,extra"
    (tmp_path / "wide.csv").write_text(f"{head}\n{row}\n")
    (tmp_path / "bare.csv").write_text("R2,S1,P1,PAIRED,ILLUMINA\n")
    scanned = scan_manifest(spark, str(tmp_path))
    good, bad = M.validate_manifest(M.normalise_manifest(scanned))
    r, = good.collect()
    assert (r.run_id, r.layout) == ("R1", "PAIRED") and r.attrs["c139"] == 'a,"b"' and r.attrs["c0"] == 'a,"b"'
    assert r.attrs["c0_146"] == "again" and r.attrs["_147"] == "extra"
    assert [(b.raw, len(b.reasons)) for b in bad.collect()] == [("R2,S1,P1,PAIRED,ILLUMINA", 5)]


def test_include_and_skip_mean_the_same_in_every_form(spark):
    df = spark.createDataFrame([("R1", "a"), ("R2", "b"), ("R3", None)], "run_id string, sample_id string")

    def frame(values):
        return spark.createDataFrame([(v,) for v in values], "sample_id string")
    for values in ([], ["a"], ["a", "b"], ["z"]):
        for names in ("include", "skip"):
            listed = sorted(r.run_id for r in M.filter_samples(df, **{names: values}).collect())
            joined = sorted(r.run_id for r in M.filter_samples(df, **{names: frame(values)}).collect())
            assert listed == joined, (names, values)
    assert M.filter_samples(df, include=[]).count() == 3


def test_an_unreadable_reference_document_is_kept(spark):
    docs = spark.createDataFrame([(1, "not json"), (2, '[{"name":"x","fastaUri":"f","indexUri":"i"}]')], "doc int, json string")
    assert {(r.doc, r.name) for r in M.references_from_json(docs).collect()} == {(1, None), (2, "x")}


def test_only_lines_that_hold_the_header_name_are_cut_to_find_it(spark):
    from helixframe.sources.manifest import parse_manifest_lines

    raw = ['Run,"a""b",c', '1,"x,""1""",""', '2,",","', '3,"""",z', '4,"Run",y']
    lines = spark.createDataFrame([(r, "f", i) for i, r in enumerate(raw)], "raw string, source_file string, manifest_row long")
    got = parse_manifest_lines(lines)
    assert "contains(" in got._jdf.queryExecution().optimizedPlan().toString().lower()
    rows = {r.manifest_row: r.attrs for r in got.collect()}
    assert rows == {1: {"Run": "1", 'a"b': 'x,"1"', "c": ""}, 2: {"Run": "2", 'a"b': ",", "c": '"'}, 3: {"Run": "3", 'a"b': '"', "c": "z"}}
