"""Explicit-schema CSV scans."""

from affinity.sources import load_datasets


def test_csv_scans_use_explicit_schema(spark, tmp_path):
    (tmp_path / "ratings.csv").write_text("userId,movieId,rating,timestamp\n1,10,4.5,100\n2,10,,200\n")
    (tmp_path / "movies.csv").write_text("movieId,title,genres\n10,Heat (1995),Action|Crime\n")
    (tmp_path / "tags.csv").write_text("userId,movieId,tag,timestamp\n1,10,classic,300\n")
    r, m, t = load_datasets(spark, str(tmp_path))
    assert r.columns == ["user_id", "item_id", "rating", "ts"]
    assert [f.dataType.simpleString() for f in r.schema.fields] == ["bigint", "bigint", "double", "bigint"]
    rows = sorted(tuple(x) for x in r.collect())
    assert rows == [(1, 10, 4.5, 100), (2, 10, None, 200)]
    assert m.collect()[0].genres == "Action|Crime"
    assert t.collect()[0].tag == "classic"
