"""The default capacity weighs pieces and attention too."""

from terrace.llm import packing


def test_attention_decides_between_bins_of_equal_room():
    steps = packing.plan({1900: 1, 1000: 2, 100: 1, 10: 1}, packing.Capacity())
    at = {length: first for length, _, _, first, _ in steps}
    assert at[10] == at[1900] == at[100] != at[1000]
    assert 1 + max(at.values()) == 2
