"""Scratch tables and the scopes that remove them."""

import os

import pytest

from landledger.session import CLEANUP, discard, kept, materialize, scratch_scope


def there(table):
    return os.path.isdir(table.scratch_path.removeprefix("file:"))


def test_scopes_remove_what_they_made(spark):
    outside = materialize(spark.range(3), "outside")
    before = spark.conf.get(CLEANUP, None)
    with scratch_scope(spark):
        first, second = materialize(outside, "first"), materialize(spark.range(4), "second")
        discard(first)
        assert not there(first) and there(second)
        with scratch_scope(spark):
            inner, result = materialize(second, "inner"), kept(materialize(second, "result"))
        assert not there(inner) and result.count() == 4
        last = kept(materialize(result, "last"))
    assert not there(result) and not there(second) and there(outside)
    assert last.count() == 4 and outside.count() == 3 and spark.conf.get(CLEANUP, None) == before
    discard(last)
    assert not there(last)


def test_scopes_remove_after_errors(spark):
    with pytest.raises(RuntimeError), scratch_scope(spark):
        table = materialize(spark.range(2), "t")
        raise RuntimeError
    assert not there(table)
    # a table outside any scope stays
    assert there(kept(materialize(spark.range(1), "t")))
