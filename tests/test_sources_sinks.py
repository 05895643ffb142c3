from encore.operators.tracks import normalize_tracks
from encore.sinks import writers
from encore.sources import fixtures
from encore.sources.readers import read_songs, read_track_pages, read_users

SF = "/root/testdata/sf0.001"


def test_users_landing_roundtrip_with_file_chunks(spark, tmp_root):
    users = fixtures.users_landing(spark, SF)
    writers.land_users(users, f"{tmp_root}/users", rows_per_file=50)
    back = read_users(spark, f"{tmp_root}/users")
    assert back.count() == users.count()
    assert back.inputFiles() and len(back.inputFiles()) >= users.count() // 50


def test_songs_snapshot_roundtrip(spark, tmp_root):
    songs = fixtures.songs_landing(spark, SF)
    out = writers.land_songs(songs, f"{tmp_root}/songs", "20240101_000000")
    assert read_songs(spark, out).count() == songs.count()


def test_track_pages_roundtrip(spark, tmp_root):
    pages = fixtures.chart_pages(spark, SF)
    pages.drop("page").write.json(f"{tmp_root}/pages")
    tracks = read_track_pages(spark, f"{tmp_root}/pages")
    assert tracks.count() == spark.read.parquet(f"{SF}/part.parquet").count()
    norm = normalize_tracks(tracks, ingested_at="2024-01-01 00:00:00")
    assert norm.filter("song_name is null or song_name = '' or artist_name = ''").count() == 0


def test_json_files_of_every_shape_are_read_whole(spark, tmp_root):
    from encore.sinks import fs
    song = '{"song_id": "%s", "song_name": "n"}'
    fs.write_text(spark, f"{tmp_root}/in/a.json", "[" + ",".join(song % f"a{i}" for i in range(5)) + "]")
    fs.write_text(spark, f"{tmp_root}/in/b.json", "\n".join(song % f"b{i}" for i in range(5)))
    fs.write_text(spark, f"{tmp_root}/in/c.json", '{\n  "song_id": "c0",\n  "song_name": "n"\n}')
    fs.write_text(spark, f"{tmp_root}/in/d.json", song % "d0")
    fs.write_text(spark, f"{tmp_root}/in/_SUCCESS", "")
    ids = sorted(r.song_id for r in read_songs(spark, f"{tmp_root}/in").collect())
    assert ids == [f"a{i}" for i in range(5)] + [f"b{i}" for i in range(5)] + ["c0", "d0"]
