from civicledger.sources import landing
from civicledger.streaming.incremental import load_new_files, read_loaded
from fixtures import price, write_array


def test_exactly_once_file_loading(spark, tmpdir_):
    land, table, ck = f"{tmpdir_}/landing", f"{tmpdir_}/table", f"{tmpdir_}/_checkpoints/market"
    write_array(f"{land}/d1_market_close.json.gz", [price("AAA", "2024-06-10", 1, 2, 1, 2, 10)] * 3)
    kw = dict(name_glob=landing.MARKET_GLOB, spread=True,
              transform=lambda files: landing.extract_market(landing.records_of(files)))
    b1 = load_new_files(spark, land, None, table, ck, **kw)
    assert len(b1) == 1 and read_loaded(spark, table).count() == 3
    b2 = load_new_files(spark, land, None, table, ck, **kw)      # same folder again
    assert b2 == [] and read_loaded(spark, table).count() == 3
    write_array(f"{land}/d2_market_close.json.gz", [price("BBB", "2024-06-11", 1, 2, 1, 2, 10)] * 2)
    write_array(f"{land}/d2_other.json.gz", [price("ZZZ", "2024-06-11", 1, 2, 1, 2, 10)])
    b3 = load_new_files(spark, land, None, table, ck, **kw)
    assert len(b3) == 1
    assert read_loaded(spark, table, b3).count() == 2                            # only the new file
    assert read_loaded(spark, table).count() == 5


def test_replayed_batch_is_not_duplicated(spark, tmpdir_):
    """A crash after a batch's write but before its commit replays the same batch id."""
    import os
    land, table, ck = f"{tmpdir_}/landing", f"{tmpdir_}/table", f"{tmpdir_}/_checkpoints/market"
    write_array(f"{land}/d1_market_close.json.gz", [price("AAA", "2024-06-10", 1, 2, 1, 2, 10)] * 4)
    kw = dict(name_glob=landing.MARKET_GLOB,
              transform=lambda files: landing.extract_market(landing.records_of(files)))
    first = load_new_files(spark, land, None, table, ck, **kw)
    assert read_loaded(spark, table).count() == 4
    # simulate the crash: the output exists but the batch was never marked committed
    for name in (f"{first[-1]}", f".{first[-1]}.crc"):     # the entry and its local checksum
        if os.path.exists(f"{ck}/commits/{name}"):
            os.remove(f"{ck}/commits/{name}")
    again = load_new_files(spark, land, None, table, ck, **kw)
    assert again == first                                   # same batch id replayed
    assert read_loaded(spark, table).count() == 4           # its partition was replaced, not appended


def test_rewritten_file_under_same_name_is_not_reloaded(spark, tmpdir_):
    """Pinned behaviour: changed content must land under a new file name."""
    land, table, ck = f"{tmpdir_}/landing", f"{tmpdir_}/table", f"{tmpdir_}/_checkpoints/market"
    kw = dict(name_glob=landing.MARKET_GLOB,
              transform=lambda files: landing.extract_market(landing.records_of(files)))
    write_array(f"{land}/d1_market_close.json.gz", [price("AAA", "2024-06-10", 1, 2, 1, 2, 10)])
    load_new_files(spark, land, None, table, ck, **kw)
    write_array(f"{land}/d1_market_close.json.gz", [price("AAA", "2024-06-10", 1, 2, 1, 2, 10)] * 5)
    assert load_new_files(spark, land, None, table, ck, **kw) == []
    assert read_loaded(spark, table).count() == 1


def test_bad_value_aborts_the_load(spark, tmpdir_):
    """The active policy: a value that does not cast aborts the load; nothing is committed."""
    import pytest
    land, table, ck = f"{tmpdir_}/landing", f"{tmpdir_}/table", f"{tmpdir_}/_checkpoints/market"
    kw = dict(name_glob=landing.MARKET_GLOB,
              transform=lambda files: landing.extract_market(landing.records_of(files)))
    write_array(f"{land}/d1_market_close.json.gz",
                [price("AAA", "2024-06-10", 1, 2, 1, 2, 10), dict(price("BBB", "2024-06-10", 1, 2, 1, 2, 10), open="x")])
    with pytest.raises(Exception):
        load_new_files(spark, land, None, table, ck, **kw)
    import os
    assert not os.path.exists(f"{ck}/commits/0")
