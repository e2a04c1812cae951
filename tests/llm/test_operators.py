"""The training-data operators against plain Python, and on odd rows."""

import hashlib
import math
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tidemark.llm import (
    candidate_groups, components, fingerprints, license_scan, line_dedup, mixing, ngram_join, packing, pii, quality_rules, secret_scan,
    set_trie, shingles, token_counts, tokens,
)
from tidemark.session import swept
from tokenizers import Tokenizer

GAP = r"[^\x20\x09-\x0D]+"


def digest(found):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(found)).encode()).hexdigest()


def base_secrets(t):
    out = []
    for m in re.finditer(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, m.end(), "assign"))
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    return out + [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 32]


def luhn(d):
    return sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (c > "4") for i, c in enumerate(reversed(d))) % 10 == 0


def base_personal(t):
    digits = lambda v: re.sub("[^0-9]", "", v)
    out = [(m.start(), 0, m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0])):
            out.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(digits(m[0])) <= 15:
            out.append((m.start(), 3, m.end(), "phone"))
    return out


TRICKY = [
    "token=abc password: secret: abcdefghijk", "PASSWORD='x.y/z+=-_' api_key : \"AKIAAKIAAKIA1234567\"", "ff" * 20 + "g" + "0" * 33,
    "a@b.c_d@e.f.g a@b..c x@y.z.", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.4", "4111-1111 1111-1111 5-5", "+1 (2) +123456789 +1234567890123456",
    "0" * 5000, "9 " * 3000, "x@" * 2000, "é token = αβγ secret=12345678é",
]


@pytest.fixture(scope="module")
def tricky(spark, small):
    rows = spark.createDataFrame(list(enumerate(TRICKY)), "doc_id long, text string")
    return rows.unionByName(small.select(F.col("doc_id") + 1000, "text").toDF("doc_id", "text"))


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_secrets_base(tricky):
    known = texts(tricky)
    for r in secret_scan.digest(secret_scan.scan_secrets(tricky)).collect():
        assert r.base_sha256 == digest(base_secrets(known[r.doc_id])), r


def test_window_entropy(spark):
    values = ["abcdefghijklmnopqrstuvwxyz", "aaaaaaaaaaaaaaaaaaaaaaaaa", "short", "0123456789abcdef0123aaaaaaaaaaaaaaaaaaa"]

    def brute(v, w=20):
        windows = [v[i : i + w] for i in range(len(v) - w + 1)]
        return max((sum(-c / w * math.log2(c / w) for c in Counter(x).values()) for x in windows), default=0.0)

    alphabet = "abcdefghijklmnopqrstuvwxyz0123456789"
    rows = spark.createDataFrame([(v,) for v in values], "v string").select("v", secret_scan.window_entropy(F.col("v"), alphabet).alias("e"))
    for r in rows.collect():
        assert r.e == pytest.approx(brute(r.v), abs=1e-9)


def test_entropy_spans_and_allow_list(spark):
    key = "aB3xK9qLm2Zt7Wp4Rv8Ny5"
    rows = spark.createDataFrame([(1, f"see {key} end"), (2, f"sha256-{key} end"), (3, "EXAMPLEaB3xK9qLm2Zt7Wp4")], "doc_id long, text string")
    found = {r.doc_id: r.spans for r in secret_scan.digest(secret_scan.scan_secrets(rows)).collect()}
    assert found == {1: "entropy_base64:4:26", 2: "", 3: ""}


def test_secrets_by_class_and_place(spark):
    """Keys of each class, in URLs and behind innocent words, against values that only look like them."""
    secret = [
        "clone https://user:q7Rz9LmXw2KpT4vBn8YcJd5s@host.example/x",
        "post to https://hooks.host.example/services/T0AB12CD/B0EF34GH/q7Rz9LmXw2KpT4vBn8YcJd5s",
        "see that commit\nghp_q7Rz9LmXw2KpT4vBn8YcJd5sHf3GaE6uPo1i",
        "commit ghp_q7Rz9LmXw2KpT4vBn8YcJd5sHf3GaE6uPo1i",
        "seed JBSWY3DPEHPK3PXPN5XG6ZLT7QRV2KWA done",
        "key is q7rz9lmxw2kpt4vbn8ycjd5shf3g ok",
        "key is q7Rz9sampleLmXw2KpT4vBn8YcJd5s ok",
    ]
    clean = [
        "sha256: q7Rz9LmXw2KpT4vBn8YcJd5sHf3G", "integrity=sha384-q7Rz9LmXw2KpT4vBn8YcJd5sHf3G",
        "see https://host.example/blog/2023/How-To-Build-Great-Things-In-2024-Part2",
        "put your_API_KEY_example_goes_HERE_1234 there", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa THISISALLUPPERCASETEXTOFWORDS",
        "id 550e8400-e29b-41d4-a716-446655440000 of a thing",
    ]
    rows = spark.createDataFrame(list(enumerate(secret + clean)), "doc_id long, text string")
    found = {r["doc_id"]: r["found"] for r in secret_scan.scan_secrets(rows).collect()}
    assert all(len(found[i]) == 1 for i in range(len(secret))), {i: found[i] for i in range(len(secret))}
    assert not any(found[len(secret) + i] for i in range(len(clean))), found
    assert [found[i][0]["kind"] for i in (0, 4, 5)] == ["entropy_base64", "entropy_base32", "entropy_base36"]
    at = found[0][0]
    assert secret[0][at["start"]:at["end"]] == "q7Rz9LmXw2KpT4vBn8YcJd5s"


def test_personal_base(tricky):
    known = texts(tricky)
    for r in pii.digest(pii.find_personal_data(tricky, pii.NO_MODEL)).collect():
        assert r.base_sha256 == digest(base_personal(known[r.doc_id])), r


def test_trees_select_by_calibrated_score(spark):
    plain = [(i, f"call me on +1 (212) 555-{1000 + i} today") for i in range(400)]
    odd = [(1000 + i, f"order no {i % 9 + 1}00.{i}.900.77 and 12345678901{i:05d}") for i in range(400)]
    docs = spark.createDataFrame(plain + odd, "doc_id long, text string")
    model = pii.fit(docs)
    assert model.trees and model.threshold <= 1
    more = spark.createDataFrame([(1, "+1 (212) 555-1234"), (2, "order no 900.1.900.77")], "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii.digest(pii.find_personal_data(more, model)).collect()}
    assert found == {1: "phone:0:17", 2: ""}
    assert pii.calibrated_threshold([(0.1, 0, 50), (0.5, 5, 5), (0.9, 50, 0)]) == 0.9
    assert pii.calibrated_threshold([(0.5, 5, 5)]) > 1
    redacted = pii.redact(pii.find_personal_data(more, model)).where("doc_id = 1").first()
    assert redacted.redacted == "[phone]"



def test_shuffle_files_of_intermediate_writes_go(spark):
    """What the joins of candidate groups shuffle is gone when their tables are written."""

    def files() -> set[str]:
        found = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return {str(found.apply(i).getName()) for i in range(found.size())}

    before = files()
    links = spark.range(20_000).select((F.col("id") % 997).alias("a"), F.col("id").alias("b"))
    kept = swept(links.groupBy("b").agg(F.min("a").alias("a")), "swept-test")
    end = time.time() + 20
    while (left := {f for f in files() - before if f.startswith("shuffle_")}) and time.time() < end:
        time.sleep(0.2)
    assert not left
    assert kept.count() == 20_000


def test_personal_fit_reads_all_documents(spark):
    """Few examples among many documents: a sample of the table would hold too few to learn from."""
    plain = [(i, f"call me on +1 (212) 555-{1000 + i} today") for i in range(60)]
    odd = [(1000 + i, f"order no {i % 9 + 1}00.{300 + i}.900.77") for i in range(60)]
    rest = spark.range(10_000, 160_000).select(F.col("id").alias("doc_id"), F.lit("nothing of that kind").alias("text"))
    docs = spark.createDataFrame(plain + odd, "doc_id long, text string").unionByName(rest)
    counted = pii.examples(docs)
    assert {(r["kind"], r["label"]): r["n"] for r in counted.groupBy("kind", "label").agg(F.sum("n").alias("n")).collect()} == {
        ("phone", 1.0): 60, ("ip", 0.0): 60,
    }
    assert counted.count() < 20
    assert pii.fit(docs).trees


REAL = {
    1: ("please call 212-555-0147 now", "phone_local:12:24"), 2: ("my SSN is 123-45-6789", "id_number:10:21"),
    3: ("pay BE68 5390 0754 7034 PAID", "iban:4:23"), 4: ("ann.lee [at] example [dot] org", "email_spoken:0:30"),
    5: ("call +290 12345", "phone:5:15"),
}
LOOK_ALIKES = {
    11: "please call 112-555-0147 now", 12: "order no 212-555-0147", 13: "my SSN is 666-45-6789", 14: "pay BE69 5390 0754 7034",
    15: "sold (at) 3.50 each", 16: "part no 123-45-6789",
}


def found_spans(spark, model):
    rows = [(i, t) for i, (t, _) in REAL.items()] + list(LOOK_ALIKES.items())
    return {r.doc_id: r.spans for r in pii.digest(pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string"), model)).collect()}


def test_generators_find_real_spans_and_no_look_alikes(spark):
    assert found_spans(spark, pii.NO_MODEL) == {i: s for i, (_, s) in REAL.items()} | dict.fromkeys(LOOK_ALIKES, "")


def test_fit_learns_contexts_of_generator_kinds(spark):
    plain = [(i, f"Visit us or ask 2{i % 9}2-555-{1000 + i} today") for i in range(1, 400) if i % 9 != 1]
    serials = [(1000 + i, f"shipment | {i * 7919 % 1000:03d}-{i * 104729 % 1000:03d}-{1000 + i} sent") for i in range(400)]
    model = pii.fit(spark.createDataFrame(plain + serials, "doc_id long, text string"))
    assert "phone_local" in dict(model.thresholds)
    assert found_spans(spark, model) == {i: s for i, (_, s) in REAL.items()} | dict.fromkeys(LOOK_ALIKES, "")
    more = spark.createDataFrame([(1, "Visit us or ask 262-555-4321 today"), (2, "shipment | 262-555-4321 sent")], "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii.digest(pii.find_personal_data(more, model)).collect()}
    assert found == {1: "phone_local:16:28", 2: ""}


def test_licenses(small, spark):
    rows = small.select("doc_id", "text").unionByName(
        spark.createDataFrame([(-1, "GNU General Public License; CC-BY 4.0, cc by cc by! MIT  license"), (-2, "ÀCC BY")], "doc_id long, text string")
    )
    known = texts(rows)
    for r in license_scan.scan_licenses(rows).collect():
        t = re.sub("[A-Z]", lambda m: m[0].lower(), known[r.doc_id])
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
        at = [(i, label) for phrase, label in license_scan.BASE for p in [phrase.split()] for i in range(len(w)) if w[i : i + len(p)] == p]
        assert (r.n_words, r.n_base, r.base_labels) == (len(w), len(at), ",".join(sorted({x for _, x in at})))
        assert (r.first_word, r.last_word) == ((min(at)[0], max(at)[0]) if at else (None, None))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_license_containment():
    rules = license_scan.RuleSet()
    kept = rules.detections(license_scan.normalised("Licensed under the Apache License, Version 2.0")[0])
    assert [d[2] for d in kept] == ["apache"]
    for a in kept:
        assert not any(a is not b and b[4] >= a[4] and b[0] <= a[0] and a[1] <= b[1] for b in kept)



SIGNED = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal"),
    ("bsd", "Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that"),
    ("bsd", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("0bsd", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\nTHE SOFTWARE IS PROVIDED"),
    ("zlib", "This software is provided 'as-is'. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("boost", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("gpl", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by"),
    ("gpl", "this program is free software; you can redistribute it"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at\n http://www.apache.org/licenses/LICENSE-2.0"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("mpl", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.mozilla.org/MPL/"),
    ("unlicense", "This is free and unencumbered software released into the public domain."), ("cc0", "https://creativecommons.org/publicdomain/zero/1.0/"),
    ("cc-by-nc-sa", "https://creativecommons.org/licenses/by-nc-sa/4.0/"), ("gpl", "https://www.gnu.org/licenses/gpl-3.0.html"),
    ("mit", "SPDX-License-Identifier: MIT"), ("apache", "SPDX-License-Identifier: Apache-2.0"), ("gpl", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("bsd", "SPDX-License-Identifier: BSD-3-Clause\nimport os"), ("apache,mit", "// SPDX-License-Identifier: (MIT OR Apache-2.0)"),
    ("bsd,gpl", "SPDX-License-Identifier: GPL-2.0-only WITH Linux-syscall-note-exception OR BSD-2-Clause"),
    ("", "you may not use this file except in compliance with the License. You can obtain a copy of the license at usr/src/OPENSOLARIS.LICENSE"),
    ("", "mit freundlichen Grüßen; permission was granted; a free program and software in use"),
]


@pytest.mark.parametrize(("labels", "text"), SIGNED)
def test_license_signatures(labels, text):
    kept = license_scan.RuleSet().detections(license_scan.normalised(text)[0])
    own = {d[2] for d in kept} - ({"public-domain"} if labels == "unlicense" else set())
    assert ",".join(sorted(own)) == labels


def test_every_spdx_id_has_its_label():
    known = license_scan.RuleSet()
    for i, label in license_scan.spdx_ids().items():
        assert label in {d[2] for d in known.detections(f" x spdx license identifier {i} y ".encode())}, i


def line_grams(line):
    w = line.lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def test_line_dedup(small, spark):
    extra = [(10_000 + i, "alpha beta gamma delta epsilon " + " ".join(f"w{j}" for j in range(30)) + (f" tail{i}" if i else "") + "\nshort\n") for i in range(6)]
    rows = small.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    seen, gone = [], defaultdict(set)
    for d, t in sorted(texts(rows).items()):
        for i, line in enumerate(t.split("\n")):
            g = line_grams(line)
            if g:
                if any(5 * len(g & h) >= 4 * len(g | h) for h in seen):
                    gone[d].add(i)
                seen.append(g)
    assert gone[10_003] == {0, 1}
    known = texts(rows)
    for r in line_dedup.dedup_lines(rows).collect():
        kept = [x for i, x in enumerate(known[r.doc_id].split("\n")) if i not in gone[r.doc_id]]
        assert (r.text, r.n_removed) == ("\n".join(kept), len(gone[r.doc_id]))


def test_line_pairs_are_cut_by_sketches(spark):
    """Only pairs whose sketches leave the similarity in reach are read again; no match is among those cut."""
    common = [f"c{i}" for i in range(9)]
    lines = [" ".join([*common, *[f"x{n}y{j}" for j in range(31)]]) for n in range(40)]
    lines += [" ".join([*common, *[f"x{n}y{j}" for j in range(31)], "end"]) for n in range(5)]
    sets = line_dedup.line_sets(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")).localCheckpoint()
    key = {r["_d"]: r["key"] for r in sets.collect()}
    pairs = spark.createDataFrame([(key[j], key[i]) for j in key for i in key if i < j], "key long, other long")
    left = {(r["key"], r["other"]) for r in line_dedup._likely(sets, pairs, "sketch-test").collect()}
    alike = {
        (key[j], key[i]) for j in key for i in key
        if i < j and 5 * len(line_grams(lines[i]) & line_grams(lines[j])) >= 4 * len(line_grams(lines[i]) | line_grams(lines[j]))
    }
    assert len(alike) == 5
    assert alike <= left
    assert len(left) < 20


def test_line_pairs_are_cut_by_the_tokens_they_share(spark):
    """Pairs that share too few posted tokens never reach the sketches; no match is among those cut."""
    lines = [" ".join([*[f"c{i}" for i in range(12)], *[f"x{n}y{j}" for j in range(38)]]) for n in range(12)]
    lines += [" ".join([*[f"c{i}" for i in range(12)], *[f"x{n}y{j}" for j in range(37 - n)]]) for n in range(6)]
    grams = [sorted(line_grams(x), key=lambda g: zlib.crc32(" ".join(g).encode())) for x in lines]
    posted = [
        (" ".join(g), k, len(of), pos)
        for k, of in enumerate(grams) for pos, g in enumerate(of[: len(of) - (4 * len(of) + 4) // 5 + 1])
    ]
    groups = spark.createDataFrame(posted, "token string, key long, n int, pos int").withColumn("place", F.col("key"))
    earlier = groups.select("token", F.col("key").alias("other"), F.col("place").alias("other_place"), F.col("n").alias("m"), F.col("pos").alias("at"))
    found = [(r["key"], r["other"]) for r in line_dedup._in_reach(groups, earlier).collect()]
    pairs = [(a, b) for a in range(len(lines)) for b in range(a)]
    tokens = [{t for t, key, _, _ in posted if key == k} for k in range(len(lines))]
    sets = [set(g) for g in grams]
    alike = {(a, b) for a, b in pairs if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}
    assert len(alike) == 6
    assert len(found) == len(set(found))
    assert alike <= set(found)
    assert len(found) < sum(bool(tokens[a] & tokens[b]) for a, b in pairs) / 2


def brute_groups(known, width, num):
    sets = {}
    for d, t in known.items():
        w = re.findall(GAP, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[d] = frozenset(tuple(w[i : i + width]) for i in range(max(len(w) - width + 1, 1))) if w else frozenset()
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]) and find(a) != find(b):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {d: (len(sets[d]), find(d)) for d in sets}


@pytest.fixture(scope="module")
def copies(spark, small):
    """A chain of near copies of more documents than a small group may have, beside the given rows."""
    words = [f"w{i}" for i in range(200)]
    chain = [(5_000 + i, " ".join(words[i // 2 : i // 2 + 120] + [f"v{i}"])) for i in range(90)]
    return small.select("doc_id", "text").unionByName(spark.createDataFrame(chain, "doc_id long, text string"))


@pytest.mark.parametrize(("width", "num"), [(3, 90), (5, 80)])
def test_ngram_join(copies, width, num):
    want = brute_groups(texts(copies), width, num)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join_documents(copies, width, num, 100).collect()}
    assert got == want


def test_fingerprint_classes(small):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in fingerprints.near_duplicates(small).collect()}
    assert got == brute_groups(texts(small), 5, 80)


def test_fingerprints_name_their_class(small):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in fingerprints.fingerprint(small).collect()}
    assert got == brute_groups(texts(small), 5, 80)
    assert len({c for _, c in got.values()}) < len(got)


def test_near_copies_travel_once(spark, monkeypatch):
    """Sets of a cluster go to their first leader, not to every pair of the cluster."""
    sent, linked = [], candidate_groups.linked

    def counted(members, *rest):
        sent.append(members.count())
        return linked(members, *rest)

    monkeypatch.setattr(candidate_groups, "linked", counted)
    body = " ".join(f"w{i}" for i in range(400))
    docs = spark.createDataFrame([(i, f"{body} tail{i}") for i in range(30)], "doc_id long, text string")
    found = ngram_join.join_documents(docs).collect()
    assert {r.component_id for r in found} == {0}
    assert sum(sent) <= 90


def test_trie_join_matches_all_pairs():
    rng = np.random.default_rng(5)
    base = [np.unique(rng.integers(0, 400, 60)) for _ in range(12)]
    sets = base + [np.unique(np.concatenate([b[: len(b) - k], rng.integers(400, 500, k)])) for b in base for k in (1, 4, 9)]
    links = set_trie.join_group(sets, list(range(len(sets))), 80, 100)
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in links:
        parent[find(i)] = find(j)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            n = len(np.intersect1d(a, b))
            if 100 * n >= 80 * (len(a) + len(b) - n):
                assert find(i) == find(j)
    assert all(100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j])) for i, j in links)


def test_trie_leaves_settled_branches():
    """Near copies that are linked already are passed by branch, not one by one."""
    asked, rng = [], np.random.default_rng(3)
    sets = [np.concatenate([np.arange(60), np.array([100 + i])]) for i in range(300)]
    settled = lambda d: asked.append(d) or d < 299
    trie = set_trie.SetTrie(80, 100)
    for i in rng.permutation(299).tolist():
        trie.add(sets[i], i, lambda d: True)
    trie.add(np.arange(60), 299, lambda d: d == 299)
    mark = np.isin(np.arange(500), sets[7])
    assert list(trie.similar(sets[7], mark, settled)) == [299]
    assert len(set_trie.join_group(sets, list(range(300)), 80, 100)) == 299
    asked.clear()
    alone = set_trie.SetTrie(80, 100)
    for i in range(299):
        alone.add(sets[i], i, lambda d: True)
    assert not list(alone.similar(sets[7], mark, settled))
    assert len(asked) < 5


def test_components_grow_by_links_between_them(spark):
    table = lambda rows, names="a long, b long": spark.createDataFrame(rows, names)
    parts = components.components(table([(1, 2), (2, 3), (10, 11), (20, 21)])).localCheckpoint()
    assert components.extended(parts, table([(1, 3), (21, 20), (7, 7)])) is parts
    got = {r.node: r.label for r in components.extended(parts, table([(3, 11), (11, 2), (0, 21), (50, 51), (1, 3)])).collect()}
    assert got == {**dict.fromkeys([1, 2, 3, 10, 11], 1), **dict.fromkeys([0, 20, 21], 0), 50: 50, 51: 50}


def test_sets_are_shuffled_by_group_alone(spark, copies, monkeypatch):
    """The few members of groups travel to the sets; the sets are not shuffled by key as well."""
    plans, linked = [], candidate_groups.linked

    def seen(members, *rest):
        out = linked(members, *rest)
        plans.append(out._jdf.queryExecution().sparkPlan().toString())
        return out

    monkeypatch.setattr(candidate_groups, "linked", seen)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fingerprints.near_duplicates(copies).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plans
    assert not [p for p in plans if "SortMergeJoin [key" in p]


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 100), (300, 300)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 200: 100}


def test_shingle_hashes_ignore_place_and_case():
    a, b = shingles.shingle_sets(["x The quick brown fox", "the QUICK brown fox y"], 3)
    assert len(np.intersect1d(a, b)) == 2
    assert [len(s) for s in shingles.shingle_sets(["", None, " \n", "one", "one two", "ONE"], 3)] == [0, 0, 0, 1, 1, 1]


@pytest.fixture(scope="module")
def ids(small):
    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    known = texts(small)
    return {d: e.ids for d, e in zip(known, model.encode_batch(list(known.values()), add_special_tokens=False))}


def check_packing(rows, ids):
    sizes, places = Counter(), defaultdict(list)
    for r in rows:
        part = (ids[r.doc_id] + [1])[r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.asarray(part, "<u4").tobytes()) and r.start == 4096 * r.piece
        sizes[r.doc_id] += r.length
        places[r.sequence_id].append((r.offset, r.length))
    assert sizes == {d: len(x) + 1 for d, x in ids.items()}
    for spots in places.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= 4096
    return len(places)


def test_packing(small, ids):
    used = check_packing(packing.pack(small).collect(), ids)
    assert used <= -(-sum(len(x) + 1 for x in ids.values()) // 4096) + 2


@pytest.mark.parametrize("histogram", [{2049: 7, 1000: 20, 3: 5}, {4096: 3}, {1: 5000}, {2048: 5}, {}])
def test_plan_uses_every_piece(histogram):
    patterns = packing.plan(histogram)
    used = Counter()
    for p, copies in patterns:
        assert sum(s * m for s, m in p.items()) <= 4096
        for s, m in p.items():
            used[s] += m * copies
    assert used == histogram


def test_knapsack_prices():
    got = packing.price_configuration(np.array([3, 5, 7]), np.array([2.0, 4.0, 6.5]), np.array([9, 9, 1]), 15)
    best = max((2 * a + 4 * b + 6.5 * c, (a, b, c)) for a in range(6) for b in range(4) for c in range(2) if 3 * a + 5 * b + 7 * c <= 15)
    assert got @ np.array([2.0, 4.0, 6.5]) == best[0]


def test_token_counts(small, ids, spark):
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(token_counts.stored_flat(small)).collect()}
    assert got == {d: len(x) for d, x in ids.items()}
    stream = np.array([5, 9, 9, 1, 2, 3, 4, 5, 6, 7, 8, 9, 1], dtype="<u2")
    blocks = [(0, i, bytearray(stream[4 * i : 4 * i + 4].tobytes()), None) for i in range(4)]
    df = spark.createDataFrame(blocks, "file int, block long, ids binary, doc_ids array<long>")
    rows = sorted((r.start, r.n_tokens, r.terminated) for r in token_counts.token_counts(df, end_id=9, block=4).collect())
    assert rows == [(0, 1, True), (2, 0, True), (3, 8, True), (12, 1, False)]


def test_mixing_meets_targets(spark):
    rows = [
        (100 * i + 10 * j + k, "word " * (1 + 7 * i + 3 * j * j + 11 * k) + ("| x" if k else ""), lang, source)
        for i, source in enumerate(("a", "b", None)) for j, lang in enumerate(("en", "de", "fr")) for k in (0, 1)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    targets = {"lang": {"en": 0.5, "de": 0.3, "fr": 0.2}, "source": {"a": 0.2, "b": 0.2, None: 0.6}, "topic": {"general": 0.5, "tabular": 0.5}}
    mixed = mixing.mix(docs, targets).collect()
    total = sum(r.tokens for r in mixed)
    for name, shares in targets.items():
        got = Counter()
        for r in mixed:
            got[r[name]] += r.tokens * r.weight / total
        assert all(got[k] == pytest.approx(v, abs=1e-3) for k, v in shares.items()), name
    assert sum(r.tokens * r.probability for r in mixed) == pytest.approx(mixing.KEEP * total, rel=1e-6)
    assert all(0 <= r.probability <= 1 for r in mixed)


def quality_counts(t):
    ws, lines = re.findall(GAP, t), [x for x in t.split("\n") if re.search(GAP, x)]
    grams = [tuple(ws[i : i + 3]) for i in range(len(ws) - 2)]
    n, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if n[g] > 1:
            covered |= {i, i + 1, i + 2}
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def test_quality_statistics(tricky):
    known = texts(tricky)
    for r in quality_rules.with_statistics(tricky).select("doc_id", "_q.*").collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == quality_counts(known[r.doc_id])


def test_binomial_bound(spark):
    def brute(n, risk, error):
        k, total = -1, 0.0
        while k < n and (total := total + math.comb(n, k + 1) * risk ** (k + 1) * (1 - risk) ** (n - k - 1)) <= error:
            k += 1
        return k

    rows = spark.createDataFrame([(0,), (1,), (30,), (150,), (700,)], "n long")
    for r in rows.select("n", quality_rules.allowed(F.col("n"), F.lit(0.01), 0.05).alias("k")).collect():
        assert r.k == brute(r.n, 0.05, 0.01), r


def test_cutoffs_keep_the_risk(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 4000")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    stats = quality_rules.with_statistics(docs).drop("text")
    judged = quality_rules.judge(stats, quality_rules.cutoffs(stats, labels)).join(labels, "doc_id").where("NOT base_failed")
    n = {(r["quality"], r["kept"]): r["n"] for r in judged.groupBy("quality", "kept").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert n.get((1, False), 0) <= quality_rules.RISK * n[1, True] and n.get((0, False), 0) > n.get((0, True), 0)


def test_successor_and_likeness(small):
    known = sorted(texts(small).items())
    got = {r.doc_id: r for r in fingerprints.fingerprint(small).collect()}
    assert len(got) == len(known)
    for (d, t), (_, after) in zip(known, known[1:] + known[:1]):
        cut = len(t) // 4
        edited = t[: len(t) - cut] + after[:cut]
        a, b, c = fingerprints.signatures([t, edited, after])
        assert got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and got[d].n_chars == len(t)
        assert (got[d].near_edited, got[d].near_next) == ((a == b).mean(), (a == c).mean())


def run_all(docs, labels):
    """Every operator on one table; row counts by operator."""
    stats = quality_rules.with_statistics(docs).drop("text")
    return {
        "secrets": secret_scan.digest(secret_scan.scan_secrets(docs)).count(),
        "licenses": license_scan.scan_licenses(docs).count(),
        "lines": line_dedup.dedup_lines(docs).count(),
        "tokens": token_counts.token_counts(token_counts.stored_flat(docs)).where("terminated").count(),
        "ngrams": ngram_join.join_documents(docs).count(),
        "mixing": mixing.mix(docs).count(),
        "personal": pii.digest(pii.find_personal_data(docs, pii.fit(docs))).count(),
        "quality": quality_rules.judge(stats, quality_rules.cutoffs(stats, labels)).count(),
        "fingerprints": fingerprints.fingerprint(docs).count(),
    }


def test_odd_rows(odd, spark):
    labels = spark.createDataFrame([(1, 1), (10, 0), (None, 1), (4, None)], "doc_id long, quality int")
    assert set(run_all(odd, labels).values()) == {odd.count()}
    packed = packing.pack(odd).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in odd.collect()}
    by_id = {r.doc_id: r for r in ngram_join.join_documents(odd).collect()}
    assert by_id[5].component_id == 4 and by_id[1].component_id == 1 and by_id[3].n_shingles == 0
    kept = {r.doc_id: r for r in line_dedup.dedup_lines(odd).collect()}
    assert kept[5].emptied and not kept[4].emptied and kept[1].text is None and kept[3].text == "   \n\t\n"


def test_empty_tables(empty, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert set(run_all(empty, labels).values()) == {0}
    assert packing.pack(empty).count() == 0


@pytest.mark.parametrize("plain", [False, True])
def test_word_encoder_gives_the_ids_of_whole_texts(small, plain):
    odd = [
        "a<|endoftext|>b don't DON'T's x's3 'll", "<|startoftext|> \x01 a\x01b \x01", "Σας é ́ 中文,字 ½ x\x1cy \x85 z w",
        "a1b2 (x)_[y]--3.14%$ \x00 \x7f", "", "  \n", "x" * 5_000,
    ]
    values = odd + list(texts(small).values())
    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    model.encode_special_tokens = plain
    want = [np.asarray(e.ids, "<u4").tobytes() for e in model.encode_batch(values, add_special_tokens=False)]
    encoder = tokens.WordEncoder(tokens.tokenizer_path(None), plain, known=500)
    assert [ids for some in tokens.batches(values, len, 5_000) for ids in encoder.encode(some)] == want
    assert encoder.encode([None]) == [b""]
