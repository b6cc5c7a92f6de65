"""Shards of packed hashes and coded values, against a dictionary."""

import numpy as np
import pytest

from eventlake.llm import hash_table
from eventlake.llm.hash_table import (
    ESCAPE,
    FILES,
    HashTable,
    ShardWriter,
    save_shard,
    save_values,
    shard_of,
    shards_of_file,
)


@pytest.mark.parametrize("rows", [1, 15, 16, 300, 70_000])
def test_all_rows_are_found_and_no_others(tmp_path, rows):
    draw = np.random.default_rng(rows)
    hashes = np.unique(draw.integers(0, 2**64, 2 * rows, dtype=np.uint64))
    draw.shuffle(hashes)
    absent, hashes = hashes[rows:], hashes[:rows]
    # Mostly small values, many different ones, and a few that take 8 bytes.
    one = np.where(draw.random(rows) < 0.9, 1, draw.integers(0, 2**40, rows))
    two = draw.integers(0, 400, rows)
    shards, sizes = 3, [0, 0, 0]
    home = shard_of(hashes, shards)
    for number in range(shards):
        here = home == number
        sizes[number] = int(here.sum())
        save_shard(str(tmp_path), "t", number, hashes[here], one=one[here], two=two[here])
    table = HashTable(str(tmp_path), "t", sizes, ["one", "two"])
    place, got_two, got_one = table.find(np.concatenate([hashes, absent, hashes[:1]]), "two", "one")
    assert (got_one[:rows] == one).all() and (got_two[:rows] == two).all()
    assert sorted(place[:rows]) == list(range(rows)) and place[-1] == place[0]
    assert (place[rows:-1] == -1).all() and not got_one[rows:-1].any()
    assert (table.at(place[:rows], "one") == one).all()
    assert (table.at(np.array([rows, rows + 7]), "two") == 0).all()


def test_values_by_place_and_more_combinations_than_codes(tmp_path):
    values = np.concatenate([np.arange(2 * ESCAPE), np.full(1000, 7), [2**63 - 1]])
    save_values(str(tmp_path), "v", 0, count=values)
    table = HashTable(str(tmp_path), "v", [len(values)], ["count"])
    assert (table.at(np.arange(len(values)), "count") == values).all()


def test_rows_that_agree_in_the_first_32_kept_bits(tmp_path):
    spread = np.array([5 << 16, 5 << 16 | 1, 5 << 16 | 9, 6 << 16], dtype=np.uint64) << np.uint64(16)
    inverse = np.uint64(pow(int(hash_table._FACTOR), -1, 1 << 64))
    save_shard(str(tmp_path), "s", 0, spread * inverse, n=np.arange(1, 5))
    table = HashTable(str(tmp_path), "s", [4], ["n"])
    others = np.array([5 << 16 | 4, 5 << 16 | 10, 7 << 16], dtype=np.uint64) << np.uint64(16)
    _, n = table.find(np.concatenate([spread, others]) * inverse, "n")
    assert n.tolist() == [1, 2, 3, 4, 0, 0, 0]


def test_empty_shard_and_too_many_values(tmp_path):
    save_shard(str(tmp_path), "e", 0, np.zeros(0, dtype=np.uint64), n=np.zeros(0, dtype=np.int64))
    table = HashTable(str(tmp_path), "e", [0], ["n"])
    place, n = table.find(np.arange(3, dtype=np.uint64), "n")
    assert (place == -1).all() and (n == 0).all()
    with pytest.raises(ValueError, match="four"):
        HashTable(str(tmp_path), "e", [0], list("abcde"))


def test_shards_of_a_file_are_looked_up_together(tmp_path):
    draw = np.random.default_rng(7)
    hashes = np.unique(draw.integers(0, 2**64, 4000, dtype=np.uint64))
    draw.shuffle(hashes)
    shards, per_file = 10, 4
    # Shards of odd and even sizes, and some without rows: the first and a whole file.
    home = shard_of(hashes, shards)
    hashes = hashes[~np.isin(home, [0, 4, 5, 6, 7])]
    absent, hashes = hashes[:300], hashes[300:]
    home = shard_of(hashes, shards)
    one = np.where(draw.random(len(hashes)) < 0.9, 1, draw.integers(0, 2**40, len(hashes)))
    two = draw.integers(0, 400, len(hashes))
    sizes = np.bincount(home, minlength=shards).tolist()
    for number in range(0, shards, per_file):
        with (
            ShardWriter(str(tmp_path), "t", number // per_file) as file,
            ShardWriter(str(tmp_path), "v", number // per_file) as by_place,
        ):
            for shard in range(number, min(number + per_file, shards)):
                here = home == shard
                if here.any():
                    file.add(hashes[here], one=one[here], two=two[here])
                    by_place.add_values(two=two[here])
    table = HashTable(str(tmp_path), "t", sizes, ["one", "two"], per_file)
    outside = np.arange(5, dtype=np.uint64)  # of the first shard
    place, got_two, got_one = table.find(np.concatenate([hashes, absent, outside]), "two", "one")
    n = len(hashes)
    assert (got_one[:n] == one).all() and (got_two[:n] == two).all()
    assert sorted(place[:n]) == list(range(n)) and (place[n:] == -1).all()
    assert (table.at(place[:n], "two") == two).all()
    values = HashTable(str(tmp_path), "v", sizes, ["two"], per_file)
    ordered = two[np.argsort(home, kind="stable")]
    assert (values.at(np.arange(n)[::-1], "two") == ordered[::-1]).all()


def test_files_hardly_grow_with_the_shards():
    for shards in (1, 63, 64, 65, 850, 4000):
        assert -(-shards // shards_of_file(shards)) <= FILES
    assert shards_of_file(64) == 1
    assert shards_of_file(1_000_000) == hash_table.SHARDS_OF_FILE


def test_no_file_of_a_writer_that_failed(tmp_path):
    with pytest.raises(KeyError), ShardWriter(str(tmp_path), "f", 0) as file:
        file.add(np.arange(9, dtype=np.uint64), n=np.arange(9) * 1000)
        raise KeyError
    assert not list(tmp_path.glob("f-*"))
