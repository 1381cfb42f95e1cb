"""Every rule is found without any other licence word around it, and no gate hides a match."""

import re
from re import _parser

import pytest

from voxsift.llm.license_rules import rules
from voxsift.llm.license_scan import scan

# Wording without any of the roots that a text once needed.
ALONE = [
    "under the same terms as Perl itself", "altered source versions must be plainly marked as such",
    "the origin of this software must not be misrepresented", "Without warranties or conditions of any kind, either express or implied",
    "This is provided AS IS.", "for research purposes only", "non-commercial use only", "noncommercial purposes", "Proprietary and confidential",
    "a registered trademark", "the Classpath exception", "GCC runtime library exception", "https://mozilla.org/MPL/2.0", "ASL 2.0", "MIT No Attribution",
    "open rail", "libpng license", "PSF license", "either version 2 of the license or at your option any later version",
    "as issued, whatever the commercial guardrails for research say",
]


def written(pattern):
    """Everything that a pattern matches."""
    whole = [""]
    for kind, told in pattern:
        match str(kind):
            case "LITERAL":
                parts = [chr(told)]
            case "IN":
                parts = [chr(c) for _, cs in told for c in ((cs,) if isinstance(cs, int) else cs)]
            case "MAX_REPEAT":
                least, most, inner = told
                once, parts, so_far = written(inner), [], [""]
                for n in range(most + 1):
                    parts += so_far if n >= least else []
                    so_far = [a + b for a in so_far for b in once]
            case "SUBPATTERN":
                parts = written(told[3])
            case "BRANCH":
                parts = [text for branch in told[1] for text in written(branch)]
        whole = [a + b for a in whole for b in parts]
    return whole


def ungated(text):
    """Labels of the rules' matches, suppressed ones left out, all rules tried on every text."""
    padded = " " + " ".join(re.findall(r"[a-z0-9]+", text.lower())) + " "
    found = []
    for number, rule in enumerate(rules()):
        for m in re.finditer(f" ({rule.pattern})(?= )", padded):
            start = padded[:m.start()].count(" ")
            found.append((start, start + m[0].count(" "), rule.rank, number, rule.label))
    return {d[4] for d in found if not any(
        e is not d and e[0] <= d[0] and e[1] >= d[1] and e[2] <= d[2] and (e[:3] != d[:3] or e[3] < d[3]) for e in found
    )}


def test_a_keyword_is_in_all_that_its_rule_matches():
    for rule in rules():
        assert all(rule.keyword in f" {text} " for text in written(_parser.parse(rule.pattern))), rule


@pytest.mark.parametrize("around", ["", "some words before {} and behind"])
def test_wording_alone_is_found(spark, around):
    texts = [around.format(text) if around else text for text in ALONE]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: set(filter(None, r.labels.split(","))) for r in scan(docs).collect()}
    want = {i: ungated(text) for i, text in enumerate(texts)}
    assert got == want and all(want[i] for i in range(len(ALONE) - 1)) and not want[len(ALONE) - 1]
