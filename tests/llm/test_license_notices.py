"""Every licence rule on the notice it is for, plain, indented and in comments."""

import pytest

from holdshort.llm import license_scan

GPL = """This program is free software{mark} you can redistribute it and/or modify
it under the terms of the GNU {name} as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU {name} for more details.

You should have received a copy of the GNU {name}
along with this program."""
NOTICES = {
    "GPL with a semicolon": ("GPL", GPL.format(mark=";", name="General Public License")),
    "GPL with a colon": ("GPL", GPL.format(mark=":", name="General Public License")),
    "AGPL": ("AGPL-3.0", GPL.format(mark=":", name="Affero General Public License")),
    "LGPL": ("LGPL", """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version."""),
    "MPL": ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    "MIT": ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED."""),
    "Apache": ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS."""),
    "ISC": ("ISC", """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted."""),
    "BSD": ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice.
2. Redistributions in binary form must reproduce the above copyright notice.
3. Neither the name of the copyright holder may be used to endorse products.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"."""),
}
MARKS = {"plain": ("", "", ""), "indented": ("", "    ", ""), "hash": ("", "# ", ""), "slashes": ("", "// ", ""),
         "block": ("/*\n", " * ", "\n */"), "dashes": ("", "-- ", "")}


@pytest.mark.parametrize("mark", MARKS)
def test_notices_show_their_licence(spark, mark):
    before, margin, after = MARKS[mark]
    rows = []
    for i, (_, text) in enumerate(NOTICES.values()):
        body = "\n".join((margin + line).rstrip() for line in text.split("\n"))
        rows.append((i, f"A note. Some words first.\n{before}{body}{after}\nint main() {{}}"))
    found = {r.doc_id: r.licenses for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (name, (licence, _)) in enumerate(NOTICES.items()):
        assert found[i] == [licence], (name, found[i])


def test_one_sentence_rules(spark):
    rows = list(enumerate(license_scan.SENTENCES.items()))
    docs = spark.createDataFrame([(i, f"{known.capitalize()}.") for i, (_, known) in rows], "doc_id long, text string")
    found = {r.doc_id: (r.known, r.licenses) for r in license_scan.scan(docs).collect()}
    single = {seq: name for name, seq in license_scan.RULES if " " not in seq}
    for i, (name, _) in rows:
        known, licenses = found[i]
        if license_scan.SENTENCES[name].split()[0] != "gnu":
            assert known == [name]
        assert licenses == ([single[name]] if name in single and known == [name] else [])
