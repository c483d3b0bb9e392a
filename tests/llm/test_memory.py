"""What a worker holds when a task of another operator starts."""

import os

from leadloom.llm import common


def resident_mb():
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE") / 1e6


def test_memory_of_another_operator_goes_back_to_the_system():
    before = resident_mb()
    common.memory_of("one")["texts"] = [bytes([k % 256]) * 2000 for k in range(100_000)]
    after = bytes([7]) * 2000  # at the end of the heap, so that the allocator can't cut it
    assert resident_mb() > before + 150 and common.memory_of("one")
    assert common.memory_of("two") == {} and "one" not in common._memories and len(after) == 2000
    assert resident_mb() < before + 60
