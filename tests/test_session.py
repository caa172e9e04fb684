from roundhaul.session import shuffle_partitions


def test_shuffle_partitions_grow_with_the_data():
    assert shuffle_partitions(1) == 200
    assert shuffle_partitions(10 * 1024**4 // 100) == 820
    assert shuffle_partitions(100 * 1024**4) == 819_200
    assert shuffle_partitions(100 * 1024**4, most=20_000) == 20_000
