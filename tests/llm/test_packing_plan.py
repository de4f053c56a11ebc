"""The dominance reduction goes on after a length without a proof, and takes a triple's copies at once."""

from tablelift.llm.packing import plan


def sequences(counts, capacity):
    groups, total = plan(counts, capacity), {}
    for n, items in groups:
        assert sum(size * copies for size, copies in items) <= capacity
        for size, copies in items:
            total[size] = total.get(size, 0) + n * copies
    assert total == counts
    return sum(n for n, _ in groups), len(groups)


def test_reduction_goes_on():
    # ending at the first length without a proof gave 64
    assert sequences({13: 40, 48: 5, 23: 5, 44: 1, 29: 1, 35: 2, 49: 40}, 50)[0] == 63


def test_triples_take_many_copies():
    assert sequences({700: 3000, 680: 3000, 660: 3000}, 2048) == (3000, 4)
    assert sequences({700: 3000_000, 680: 3000_000, 660: 3000_000}, 2048) == (3000_000, 4)
