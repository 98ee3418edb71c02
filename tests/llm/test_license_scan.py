import re
import textwrap

import numpy as np
import pytest

from shredline.llm import license_scan

LINES = {
    "Licensed under CC BY-NC 4.0.": "cc-by-nc",
    "Licensed under CC BY 4.0.": "cc-by",
    "This work is licensed under the GNU General Public License, version 3.": "gpl",
    "Licensed under the Apache License, Version 2.0.": "apache-2.0",
    "Released under the MIT License.": "mit",
    "All rights reserved.": "all-rights-reserved",
}


def found(spark, docs):
    docs = spark.createDataFrame([(*d, "clash") for d in docs], "doc_id long, text string, family string")
    return sorted(((r.doc_id, r.paragraph, r.family) for r in license_scan.license_paragraphs(spark, docs).collect()), key=str)


WRITTEN = {
    "SPDX-License-Identifier: MIT": "mit", "// SPDX-License-Identifier: GPL-2.0-or-later": "gpl", "License: ISC": "isc", "Licensed under the MPL 2.0": "mpl-2.0",
    "CC BY-ND 4.0": "cc-by-nd", "# SPDX-License-Identifier: LGPL-3.0-only": "lgpl", "* Licensed under the Eclipse Public License 2.0": "epl", "Released under the zlib License.": "zlib",
    "Licensed under the Artistic License 2.0.": "artistic", "Distributed under the Boost Software License, Version 1.0.": "bsl-1.0", "License: BSD-3-Clause": "bsd",
}


def test_notices(spark):
    docs, wanted = [], []
    for k, (line, family) in enumerate({**LINES, **WRITTEN}.items()):
        docs += [(10 * k, f"Some text.\n\n{line}\n\nMore."), (10 * k + 1, f"Copyright 2020 A. Person. {line.upper()}"), (10 * k + 1, f"Copyright 2020 A. Person. {line.upper()}"), (None, line)]
        wanted += [(10 * k, 2, family), (10 * k + 1, 0, family), (10 * k + 1, 0, family), (None, 0, family)]
    assert found(spark, docs) == sorted(wanted, key=str)


def test_other_text(spark):
    docs = [(1, None), (2, ""), (3, "\n\n"), (4, "The driver has a license and the version of this work is free."), (5, "of the to in and " * 20_000), (6, "rights reserved seats all"), (7, "public general version software under")]
    assert found(spark, docs) == []
    assert found(spark, []) == []


def test_long_line_is_read_whole(spark):
    assert found(spark, [(1, "some other words " * 5000 + "Released under the MIT License.")]) == [(1, 0, "mit")]


def test_wrapped_notices(spark):
    """Every published notice, wrapped, in a comment and in a run with other text, gives one row, of its family and first line."""
    docs, wanted = [], []
    for width in (40, 72, 79, 100):
        for family, notices in license_scan.PUBLISHED.items():
            for text in notices:
                lines = textwrap.wrap(text, width)
                for head, mark in (([], ""), (["Some words of the work."], ""), (["/*", "* Copyright 2020", "*"], " * "), (["\r", "A file with the text of it"], "# ")):
                    body = [*head, *(mark + x for x in lines), "More of the same work."]
                    docs.append((len(docs), "\n".join(body)))
                    wanted.append((len(docs) - 1, len(head), family))
    assert found(spark, docs) == sorted(wanted, key=str)


def test_wrapped_notices_side_by_side(spark):
    mit, bsd = ("\n".join(textwrap.wrap(license_scan.NOTICES[f][-1], 72)) for f in ("mit", "bsd"))
    n = mit.count("\n") + 1
    assert found(spark, [(1, f"{mit}\n{bsd}\n{mit}")]) == [(1, 0, "mit"), (1, n, "bsd"), (1, n + bsd.count("\n") + 1, "mit")]
    assert found(spark, [(1, "All rights\n\nreserved."), (2, "Released under"), (3, "the MIT License."), (4, "of the\nto any person\nin the work " * 3000)]) == []


def test_every_template_is_of_its_family():
    model = license_scan.Model()
    for family, texts in license_scan.NOTICES.items():
        for text in texts:
            (row,) = model([license_scan.PlainWords().text(text.encode())])
            assert (row[1], row[3]) == (family, 1.0), text


def test_probabilities_are_calibrated(spark, sf):
    """On held-out rows, predictions of any confidence are right as often as they say."""
    prose = [x for r in spark.read.parquet(f"{sf}/documents.parquet").collect() for x in r.text.split("\n") if 20 < len(x) < 2000][:600]
    model = license_scan.Model(prose)
    p = model.softmax(model.held.dot(model.weights[:-1]) + model.weights[-1])
    sure, right = p.max(1), p.argmax(1) == model.held_classes
    bins = (sure * 10).astype(int)
    assert sum(abs(sure[bins == b].mean() - right[bins == b].mean()) * (bins == b).mean() for b in np.unique(bins)) < 0.05
    assert right.mean() > 0.93


def test_sparse_rows():
    rng = np.random.default_rng(2)
    rows = [np.unique(rng.integers(0, 30, rng.integers(0, 8))) for _ in range(40)]
    dense = np.array([[k in r for k in range(30)] for r in rows], float)
    x, w, e = license_scan.SparseRows(rows, 30), rng.normal(size=(30, 4)), rng.normal(size=(40, 4))
    assert np.allclose(x.dot(w), dense @ w) and np.allclose(x.transposed_dot(e), dense.T @ e)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_documents(spark, sf):
    wanted = [
        (r.doc_id, k, LINES[line])
        for r in spark.read.parquet(f"{sf}/documents.parquet").collect()
        for k, line in enumerate(r.text.split("\n"))
        if line in LINES
    ]
    got = [(r.doc_id, r.paragraph, r.family) for r in license_scan.op4_license_scan(spark, sf).collect()]
    assert sorted(got) == sorted(wanted)
    assert not [r for r in got if not re.fullmatch("[a-z0-9.-]+", r[2])]
