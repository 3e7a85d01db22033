from siltstone.operators import channels

ROW = "channel string, sequence long, archive_hash string, pack_version string"


def told(frame):
    return sorted(((r.channel or "", r.sequence or 0, r.archive_hash or "", r.status) for r in frame.collect()))


def index(spark, path, version=None):
    return sorted((r.channel, r.archive_hash, r.sequence, r.previous_version, r.is_active) for r in channels.entries(spark, path, version).collect())


def test_versions_of_an_index(spark, tmp_path):
    path = str(tmp_path / "index")
    batch = lambda *rows: spark.createDataFrame(rows, ROW)
    assert index(spark, path) == []
    first = batch(("a", 1, "x", "1.0"), ("a", 1, "x", "1.0"), ("a", 2, "y", "1.1"), ("b", 1, "x", "1.0"), ("b", 1, "z", "9"), (None, 1, "x", "1"), ("a", None, "x", "1"))
    assert told(channels.publish(first, path, 0)) == [("", 1, "x", "refused"), ("a", 0, "x", "refused"), ("a", 1, "x", "published"), ("a", 2, "y", "published"), ("b", 1, "x", "published"), ("b", 1, "z", "refused")]
    assert index(spark, path) == [("a", "x", 1, None, False), ("a", "y", 2, "1.0", True), ("b", "x", 1, None, True)]
    second = batch(("a", 3, "x", "1.0"), ("a", 1, "x", "1.0"), ("a", 2, "y", "1.1"))
    assert told(channels.publish(second, path, 1)) == [("a", 1, "x", "unchanged"), ("a", 2, "y", "unchanged"), ("a", 3, "x", "published")]
    assert index(spark, path) == [("a", "x", 3, "1.1", True), ("a", "y", 2, "1.0", False), ("b", "x", 1, None, True)]
    assert told(channels.publish(batch(("a", 1, "x", "1.0")), path, 2)) == [("a", 1, "x", "late")]
    assert told(channels.publish(batch(), path, 2)) == []
    assert channels.head(spark, path)[0] == 2  # nothing new, no version
    assert index(spark, path, 1) == [("a", "x", 1, None, False), ("a", "y", 2, "1.0", True), ("b", "x", 1, None, True)]


def test_of_two_writers_one_wins(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "index")
    rows = [spark.createDataFrame([("a", 1, f"x{k}", str(k))], ROW) for k in (0, 1)]
    seen = channels.head(spark, path)
    assert told(channels.publish(rows[0], path, 0)) == [("a", 1, "x0", "published")]
    before = index(spark, path)
    assert told(channels.publish(rows[1], path, 0)) == [("a", 1, "x1", "conflict")]  # it sees that it is late
    with monkeypatch.context() as stale:  # it saw the index before the other committed
        stale.setattr(channels, "head", lambda *_: seen)
        assert told(channels.publish(rows[1], path, 0)) == [("a", 1, "x1", "conflict")]
    assert index(spark, path) == before and channels.head(spark, path)[0] == 1


def test_a_commit_copies_only_the_buckets_it_changes(spark, tmp_path):
    path = str(tmp_path / "index")
    channels.publish(spark.createDataFrame([(f"c{k}", 1, "x", "1") for k in range(40)], ROW), path, 0)
    one = channels.head(spark, path)[1]
    channels.publish(spark.createDataFrame([("c7", 2, "y", "2")], ROW), path, 1)
    two = channels.head(spark, path)[1]
    assert one.keys() == two.keys() and sum(one[b] != two[b] for b in one) == 1
    assert len(index(spark, path)) == 41


def test_retirements(spark, tmp_path):
    path = str(tmp_path / "retired")
    fields = "pack_id string, pack_version string, pack_sha256 string, reason string, replacement_version string, retired_at string, issuer string"
    good, blank = ("p", "1", "x", "broken", "2", "t1", "me"), ("p", "1", "x", "  ", None, "t1", "me")
    rows = spark.createDataFrame([good, good, blank, (*good[:6], None)], fields)
    assert sorted(r.status for r in channels.retire(rows, path).collect()) == ["refused", "refused", "unchanged", "written"]
    assert sorted(r.status for r in channels.retire(rows.limit(1), path).collect()) == ["unchanged"]
    index_path = str(tmp_path / "index")
    channels.publish(spark.createDataFrame([("a", 1, "x", "1"), ("b", 1, "y", "1")], ROW), index_path, 0)
    got = channels.in_force(channels.entries(spark, index_path), rows)
    assert sorted((r.channel, r.retired, r.replacement_version) for r in got.collect()) == [("a", True, "2"), ("b", False, None)]
