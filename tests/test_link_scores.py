"""link_scores against scores written out by hand: every row of the batch, awkward names too."""

import os
import re

import pytest

from sitegrain.plans import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are absent")

LINKS = [("/team/weber-anna", "dr. weber"), ("/doctors/maria-de-la-cruz", "meet dr. cruz"), ("/john-smith/carter", "single carter"), ("/profile/1", "anna weber, dds")]
#: c_custkey % 9: last name and slug after titles, credentials and case are taken off.
NAMES = [("found", "not-found"), ("weber", "anna-weber"), ("smith", "john-smith"), ("single", "single"), ("group", "bright-dental-group"), ("carter", "a-b-carter"), ("com", "info@x-com"), ("", ""), ("cruz", "maria-de-la-cruz")]


def brute(pos):
    (last, slug), (href, text) = NAMES[pos % 9], LINKS[pos // 9 % 4]
    score = 10 * (last != "" and last in href) + 8 * (last != "" and last in text) + 15 * ("-" in slug and all(w in href for w in slug.split("-")))
    score += 3 * any(w in href for w in ("bio", "profile", "doctor", "team", "provider", "dentist", "meet", "about", "dr-", "/dr/", "staff"))
    return score + 2 * bool(re.search(r"\b(?:dr|dds|dmd)\b", text))


def test_all_rows_are_scored(spark):
    got = {r.pos: r.score for r in catalog.Q["link_scores"](spark, SF).collect()}
    rows = [r.pos for r in catalog.batch(spark, SF).select("pos").collect()]
    assert got == {pos: brute(pos) for pos in rows}
    assert {pos % 9 for pos in got} == set(range(9))
