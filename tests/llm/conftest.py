import random
import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent), str(Path(__file__).resolve().parents[2])]

from llm_cases import prose  # noqa: E402


@pytest.fixture(scope="session")
def cases():
    """Copies, near copies, shared passages, repeats inside a text, other scripts, empty, NULL and very long texts."""
    rng = random.Random(3)
    passage = prose(rng, 60)
    base = prose(rng, 90)
    rows = [(i, prose(rng, rng.randint(1, 120))) for i in range(10, 30)]
    rows += [(40 + i, base) for i in range(6)]
    rows += [(50 + i, base.replace(" ", "  ", i)) for i in range(3)]
    rows += [(60 + i, f"{prose(rng, 15)} {passage} {prose(rng, 9)}") for i in range(5)]
    rows += [(70, f"{passage} {passage}"), (71, passage[7:-3]), (72, "x " * 400), (73, "é" * 300), (74, "日本語 テスト " * 40)]
    rows += [(80, None), (81, ""), (82, " \n\t "), (83, "one"), (84, "Two Words"), (85, "A-b_C\x1cd e"), (86, None)]
    rows += [(90, "ab" * 30_000), (91, prose(rng, 20_000) + " " + passage)]
    rows += [(60, next(t for i, t in rows if i == 60))]  # a repeated row
    return rows
