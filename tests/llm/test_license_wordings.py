from __future__ import annotations

import pytest

from almanack.llm import license_scan as S
from tests.llm.conftest import frame, prose

WORDINGS = {
    "Licensed under the MIT License.": "mit",
    "This project uses the MIT license": "mit",
    "(c) 2020, MIT Licence": "mit",
    "Apache License 2.0": "apache-2.0",
    "available under the Apache License, Version 2.0": "apache-2.0",
    "Boost Software License": "boost",
    "Text is available under CC BY-SA": "cc-by-sa",
    "Creative Commons Attribution-ShareAlike": "cc-by-sa",
    "a CC BY-NC picture": "cc-by-nc",
    "GNU Lesser General Public License": "lgpl",
    "GNU GPL v3": "gpl-work",
    "The Mozilla Public License 2.0 applies": "mpl-2.0",
    "BSD 3-Clause": "bsd",
    "mit der license": "",
    "mit": "",
}


@pytest.mark.parametrize("common", ["", " mit der under license", " the license software public general apache version 2 0"])
def test_wordings_that_are_no_templates(spark, common):
    """Whichever of the words the corpus makes common."""
    rows = [(i, t) for i, t in enumerate(WORDINGS)]
    rows += [(1000 + i, prose(i, 20) + " released" * (i % 50 == 0) + common) for i in range(300)]
    got = {r["doc_id"]: set(r["labels"].split(",")) for r in S.scanned(frame(spark, rows)).collect()}
    base = {t.label for t in S.BASE}
    for i, (text, label) in enumerate(WORDINGS.items()):
        assert got[i] - base - {""} == {label} - {""}, text
