from types import SimpleNamespace

import pytest

from smeltery import session

SHUFFLE = "spark.sql.shuffle.partitions"


@pytest.mark.parametrize("stored,slots,partitions", [(0, 8, 8), (10**9, 8, 12), (10**12, 4000, 11176), (10**14, 4000, 1117588)])
def test_shuffle_partitions(stored, slots, partitions):
    assert session.shuffle_partitions(stored, slots) == partitions


def test_partitions_stay_small_unless_a_setting_says_otherwise(spark):
    for stored in (10**9, 10**12, 10**14):
        assert 3 * stored / session.shuffle_partitions(stored, 8) <= 256 * 1024**2
    assert session.shuffle_partitions(10**14, 8, most=32_768) == 32_768
    spark.conf.set(session.MOST_PARTITIONS, "100")
    try:
        assert session._settings(spark, 10**14)["spark.sql.shuffle.partitions"] == "100"
    finally:
        spark.conf.unset(session.MOST_PARTITIONS)


def test_stored_bytes(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.csv").write_bytes(b"12345")
    (tmp_path / "a" / "deep").mkdir()
    (tmp_path / "a" / "deep" / "y.csv").write_bytes(b"123")
    (tmp_path / "b.csv").write_bytes(b"1")
    paths = [str(tmp_path / name) for name in ("a", "b.csv", "missing")]
    assert session.stored_bytes(spark, *paths) == 9
    assert session.stored_bytes(spark) == 0


def test_tuned_restores_settings(spark, tmp_path):
    (tmp_path / "x").write_bytes(b"1")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "false")
    before = {key: spark.conf.get(key) for key in (SHUFFLE,)}
    with pytest.raises(ZeroDivisionError):
        with session.tuned(spark, str(tmp_path)):
            assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"
            1 / 0
    assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "false"
    assert {key: spark.conf.get(key) for key in before} == before
    session.tune(spark)
    assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_folder(spark) == named
    first, second = (session.new_folder(spark, "x") for _ in range(2))
    assert first.startswith(f"{named}/smeltery/x-") and first != second


def test_shared_folder_without_a_name_is_beside_the_tables():
    unnamed = SimpleNamespace(conf={"spark.sql.warehouse.dir": "s3a://shop/tables"})
    assert session.shared_folder(unnamed) == "s3a://shop/tables/_shared"
