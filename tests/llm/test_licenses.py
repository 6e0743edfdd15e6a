from pathlib import Path

from pyspark.sql import functions as F

from tillroll.llm.licenses import KNOWN, builtin, with_licenses

MIT = KNOWN[0][1]


def test_whole_texts_and_lines(docs_of, spark):
    rows = [
        (1, "Copyright (c) 2020 Someone\n\n" + MIT.upper().replace("\n", "  \n ").replace(",", ";")),
        (2, "© 2021 Someone else\n# " + MIT.replace("NONINFRINGEMENT", "non-infringement")),
        (3, "Some prose.\nReleased under the MIT Licence!\nLicensed under the Apache License, version 2.0"),
        (4, "RELEASED UNDER THE MIT LICENSE"), (5, None), (6, ""), (7, "!!\n\n"), (8, "prose about the MIT License."),
        (None, "Released under the MIT License."), (9, "Released under the MIT License.\n" * 5000),
        (4, "RELEASED UNDER THE MIT LICENSE")]
    docs = docs_of(rows, **{c: F.lit("x") for c in ("digest", "license_id", "lines", "content", "key", "notices")})
    got = [tuple(r) for r in with_licenses(docs, builtin(spark)).collect()]
    by = {r[0]: r[2:] for r in got}
    assert len(got) == len(rows)
    assert by[1] == ("MIT", []) and by[2] == (None, [])
    assert by[3] == (None, ["Apache-2.0", "MIT"]) and by[4] == ("MIT", ["MIT"]) == by[None]
    assert by[5] == by[6] == by[7] == by[8] == (None, [])
    assert {r[0] for r in got if r[1] is None} == {5, 6, 7}
    assert by[9] == (None, ["MIT"]) and len([r for r in got if r[0] == 4]) == 2


def test_empty_tables(docs_of, spark):
    docs = docs_of([(1, "Released under the MIT License.")])
    assert with_licenses(docs.limit(0), builtin(spark)).count() == 0
    assert with_licenses(docs, builtin(spark).limit(0)).first()["notices"] == []


def test_full_texts_with_and_without_title(docs_of, spark):
    texts = Path(__file__).parents[2] / "tillroll/llm/license_texts"
    read = lambda name: (texts / f"{name}.txt").read_text()
    isc = KNOWN[1][1]
    want = {
        "MIT License\n\nCopyright (c) 2024 A\n\n" + MIT: "MIT",
        "The MIT License (MIT)\nCopyright (c) 2024 A\nAll rights reserved.\n" + MIT: "MIT",
        "Copyright (c) 2024 A\nAll rights reserved.\n\n" + MIT: "MIT",
        "ISC License\n\nCopyright (c) 2024, A\n\n" + isc: "ISC",
        "BSD 3-Clause License\n\nCopyright (c) 2024, A\nAll rights reserved.\n\n" + read("BSD-3-Clause"): "BSD-3-Clause",
        "Copyright (c) 2024, A\n\n" + read("BSD-2-Clause"): "BSD-2-Clause",
        read("Unlicense"): "Unlicense",
        read("Apache-2.0"): "Apache-2.0",
        read("Apache-2.0").split("APPENDIX")[0]: "Apache-2.0",
        read("Apache-2.0")[read("Apache-2.0").index("TERMS AND"):]: "Apache-2.0",
        **{read(x): x for x in ("GPL-2.0-only", "GPL-3.0-only", "LGPL-2.1-only", "LGPL-3.0-only", "MPL-2.0", "CC0-1.0")},
        read("GPL-3.0-only")[:9000]: None,
    }
    got = with_licenses(docs_of(list(enumerate(want))), builtin(spark)).collect()
    assert {r["doc_id"]: r["license_id"] for r in got} == dict(enumerate(want.values()))
