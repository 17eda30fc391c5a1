"""Readers, on small files."""

import gzip

from harkline.operators import clean
from harkline.sources import attributes, catalogue, text


def write(path, content, compressed=False):
    path.parent.mkdir(parents=True, exist_ok=True)
    if compressed:
        with gzip.open(path, "wt") as f:
            f.write(content)
    else:
        path.write_text(content)


def values(df):
    return sorted(tuple(row) for row in df.collect())


def test_untyped_csv(spark, tmp_path):
    write(tmp_path / "a.csv", "1,x\n2,y\n")
    df = text.read_delimited(spark, str(tmp_path / "a.csv"))
    assert df.columns == ["_c0", "_c1"]
    assert values(df) == [("1", "x"), ("2", "y")]


def test_header_csv_in_gzip(spark, tmp_path):
    write(tmp_path / "a.csv.gz", "id,name\n7,z\n", compressed=True)
    df = text.read_delimited(spark, str(tmp_path / "a.csv.gz"), header=True)
    assert df.dtypes == [("id", "string"), ("name", "string")]
    assert values(df) == [("7", "z")]


def test_triplets_in_a_folder_of_gzip_parts(spark, tmp_path):
    write(tmp_path / "t.tsv/part-0.tsv.gz", "u1\ts1\t3\nu1\ts2\t1\n", compressed=True)
    write(tmp_path / "t.tsv/part-1.tsv.gz", "u2\ts1\t5\n", compressed=True)
    df = text.read_triplets(spark, str(tmp_path / "t.tsv"), partitions=3)
    assert df.dtypes == [("user_id", "string"), ("song_id", "string"), ("play_count", "int")]
    assert df.rdd.getNumPartitions() == 3
    assert values(df) == [("u1", "s1", 3), ("u1", "s2", 1), ("u2", "s1", 5)]


def test_genres(spark, tmp_path):
    write(tmp_path / "g.tsv", "T1\tNew Age\nT2\tRap\n")
    assert values(text.read_genres(spark, str(tmp_path / "g.tsv"))) == [("T1", "New Age"), ("T2", "Rap")]


def test_mismatch_lines(spark, tmp_path):
    song, track = "SOUMNSI12AB0182807", "TRMMGKQ128F9325E10"
    write(tmp_path / "m.txt", f"ERROR: <{song} {track}> one  !=  two\n")
    lines = text.read_lines(spark, str(tmp_path / "m.txt"))
    assert values(text.parse_mismatches(lines)) == [(song, track)]


def test_attribute_schema_keeps_order_and_skips_blank_lines(spark, tmp_path):
    write(tmp_path / "a.csv", "zeta,NUMERIC\r\nalpha,real\r\n\r\nMSD_TRACKID,string\r\nodd,numeric\r\n")
    schema = attributes.attribute_schema(spark, str(tmp_path / "a.csv"))
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in schema] == [
        ("zeta", "double", True),
        ("alpha", "double", True),
        ("MSD_TRACKID", "string", True),
        ("odd", "string", True),
    ]


def music_folder(root):
    for name in catalogue.FEATURE_SETS.values():
        write(root / f"audio/attributes/{name}.attributes.csv", "first,NUMERIC\nsecond,real\nMSD_TRACKID,STRING\n")
        write(root / f"audio/features/{name}.csv/part-0.csv.gz", "1.5,2,'TRMMGKQ128F9325E10'\n", compressed=True)
    for place in catalogue.GENRE_FILES.values():
        write(root / place, "TRMMGKQ128F9325E10\tRap\n")
    for place in catalogue.HEADER_FILES.values():
        write(root / place, "track_id,title\nTRMMGKQ128F9325E10,x\n", compressed=True)
    write(root / catalogue.TRIPLETS / "part-0.tsv.gz", "u1\ts1\t3\n", compressed=True)
    write(root / catalogue.MISMATCHES, "ERROR: <SOUMNSI12AB0182807 TRMMGKQ128F9325E10> a != b\n")


def test_catalogue_loads_every_dataset(spark, tmp_path):
    music_folder(tmp_path)
    data = catalogue.Catalogue(spark, str(tmp_path))
    assert len(data.names()) == 21
    for name in data.names():
        assert data.load(name).count() == 1, name
    features = data.load("spectral")
    assert features.dtypes == [("first", "double"), ("second", "double"), ("MSD_TRACKID", "string")]
    assert data.load_untyped("spectral").columns == ["_c0", "_c1", "_c2"]
    assert data.load_untyped("triplets").dtypes[2] == ("_c2", "string")
    labelled = clean.label_features(data.load("genre"), clean.normalize_track_id(features))
    assert values(labelled) == [("TRMMGKQ128F9325E10", "Rap", 1.5, 2.0)]


def test_file_catalogue(spark, tmp_path):
    write(tmp_path / "a.txt", "12345")
    write(tmp_path / "x/y/b.txt", "1")
    df = catalogue.file_catalogue(spark, str(tmp_path))
    assert values(df.drop("modificationTime")) == [("a.txt", "", 1, 5), ("x/y/b.txt", "x/y", 3, 1)]


def test_preview_is_ordered(spark):
    df = spark.range(100).selectExpr("100 - id AS v")
    assert values(catalogue.preview(df, ["v"], 3)) == [(1,), (2,), (3,)]


def test_catalogue_of_a_root_with_odd_characters(spark, tmp_path):
    folder = tmp_path / "a+b (c)" / "deep"
    folder.mkdir(parents=True)
    (folder / "x.txt").write_text("hello")
    row = catalogue.file_catalogue(spark, str(tmp_path / "a+b (c)")).head()
    assert (row["path"], row["folder"], row["depth"], row["length"]) == ("deep/x.txt", "deep", 2, 5)
