"""Media streams, sharded tables, url templates and chat perspectives."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from concurrent.futures import ThreadPoolExecutor

import pytest
import regex
from pyspark.sql import functions as F

from kithline.llm import compaction, mpeg_media, perspectives, url_templates
from kithline.llm import queries as llm_queries
from kithline.llm.common import new_path


@pytest.mark.parametrize("n", [0, 1, 575, 576, 577, 1152, 60000])
def test_streams_hold_any_bytes(n):
    rng = random.Random(n)
    text = bytes(rng.choice([0, 65, 0xC3, 0xE0, 0xFE, 0xFB]) for _ in range(n))
    media = mpeg_media.wrap(text)
    found = mpeg_media.scan(media)
    assert mpeg_media.unwrap(media, found) == text.ljust(max(1, -(-n // 576)) * 576, b"\xff")
    assert (found.skipped, found.bad_checksums, found.samples) == (0, 0, 576 * max(1, -(-n // 576)))
    name, frames, size, points = found.table
    assert (name, frames, size, len(points)) == ("Info", len(found.offsets), len(media) - (len(media) - size), 100)
    assert all(media[a : a + 2] == b"\xff\xf2" for a in found.offsets) and found.offsets[-1] + found.lengths[-1] == len(media)
    seek = [found.offsets[len(found.offsets) * p // 100] - (len(media) - size) for p in range(100)]
    assert list(points) == [min(255, 256 * s // size) for s in seek]


def test_scan_resynchronises_and_verifies():
    media = mpeg_media.wrap(b"abc" * 5000)
    whole = mpeg_media.scan(media)
    cut = whole.offsets[5]
    junk = b"\xff\xf2junk\xff" * 9
    found = mpeg_media.scan(media[:cut] + junk + media[cut:] + b"TAG" + b"title".ljust(125, b"\0"))
    assert found.skipped == len(junk) and len(found.offsets) == len(whole.offsets) and found.tags["v1:title"] == "title"
    broken = bytearray(media)
    broken[whole.offsets[3] + 8] ^= 1
    assert mpeg_media.scan(bytes(broken)).bad_checksums == 1
    lost = mpeg_media.scan(media[: whole.offsets[2] + 7] + media[whole.offsets[4] :])
    assert lost.samples in (whole.samples - 2 * 576, whole.samples - 576) and mpeg_media.scan(b"").samples == 0
    assert mpeg_media.scan(b"\xff" * 3000).feature().startswith("none;")


@pytest.mark.parametrize(("word", "version", "layer", "length", "samples"), [(0xFFFB9064, "1", 3, 417, 1152), (0xFFFB9264, "1", 3, 418, 1152), (0xFFFD8804, "1", 2, 576, 1152), (0xFFFF4404, "1", 1, 128, 384), (0xFFF344C4, "2", 3, 96, 576), (0xFFE344C4, "2.5", 3, 192, 576)])
def test_headers(word, version, layer, length, samples):
    got = mpeg_media.header(word)
    assert (got.version, got.layer, got.length, got.samples) == (version, layer, length, samples)
    assert mpeg_media.header(word | 0xF000) is None and mpeg_media.header(word & ~0xF000).length == 0


def plain_crc(bits):
    """CRC-16 of a text of 0 and 1 by long division: the start value is added to the first 16 bits."""
    rest = int(bits, 2) << 16 ^ 0xFFFF << len(bits)
    for k in range(len(bits) - 1, -1, -1):
        if rest >> (k + 16) & 1:
            rest ^= 0x18005 << k
    return rest


def plain_parse(media):
    """An independent reading of a wrapped stream: (payload, frame places, right checksums, frames and bytes by the table, text size)."""
    size = media[6] * 2097152 + media[7] * 16384 + media[8] * 128 + media[9]
    count = int(media[10 : 10 + size].split(b"bytes\0")[1])
    at, places, payload, right, table = 10 + size, [], b"", 0, None
    while at < len(media):
        bits = "".join(f"{x:08b}" for x in media[at : at + 17])
        assert bits[:15] == "111111111111001"  # MPEG-2, layer III
        kbps = [0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160][int(bits[16:20], 2)]
        length = 72 * kbps * 1000 // [22050, 24000, 16000][int(bits[20:22], 2)] + int(bits[22])
        if bits[15] == "1":
            assert media[at + 13 : at + 17] == b"Info"
            table = [int.from_bytes(media[at + k : at + k + 4], "big") for k in (21, 25)]
        else:
            right += plain_crc(bits[16:32] + bits[48:120]) == int(bits[32:48], 2)
            places.append(at)
            n = media[at + 15] * 256 + media[at + 16]
            payload += media[at + 17 : at + 17 + n]
        at += length
    return payload, places, right, table, count


@pytest.mark.parametrize("n", [0, 1, 575, 576, 577, 5000])
def test_streams_read_by_another_parser(n):
    text = bytes(random.Random(n).randrange(256) for _ in range(n))
    media = mpeg_media.wrap(text)
    payload, places, right, table, count = plain_parse(media)
    found = mpeg_media.scan(media)
    assert payload == mpeg_media.padded(text) == mpeg_media.unwrap(media, found) and count == n
    assert places == found.offsets and right == len(places) and table == [len(places), len(media) - media.index(b"Info") + 13]
    seek = zlib.crc32(b"".join(p.to_bytes(8, "little") for p in places))
    assert found.feature() == f"mpeg2-layer3-16000;cbr;frames={len(places)};samples={576 * len(places)};table=1;bad=0;skipped=0;seek={seek:08x}"


@pytest.mark.parametrize(("word", "length", "bits"), [
    (0xFFFE4404, 128, 256), (0xFFFE44C4, 128, 128), (0xFFFE4454, 128, 4 * (2 * 8 + 24)),  # layer I: stereo, mono, joint from subband 8 on
    (0xFFFC88C0, 0, "b"), (0xFFFC8800, 0, "a44"), (0xFFFC14C4, 0, "c"), (0xFFF484C4, 0, "low"), (0xFFFC8860, 0, "joint"),
])
def test_checksums_of_layers_1_and_2(word, length, bits):
    head = mpeg_media.header(word)
    length = length or head.length
    frames = []
    for k in range(3):
        body = bytearray(word.to_bytes(4, "big") + b"\0\0" + bytes(random.Random(k).randrange(256) for _ in range(length - 6)))
        after = "".join(f"{x:08b}" for x in body[6:60])
        if isinstance(bits, int):
            n = bits
        else:  # read the allocation as the standard lists it
            wide = {"b": [4] * 11 + [3] * 12 + [2] * 7, "a44": [4] * 11 + [3] * 12 + [2] * 4, "joint": [4] * 11 + [3] * 12 + [2] * 4, "c": [4, 4] + [3] * 6, "low": [4] * 4 + [3] * 7 + [2] * 19}[bits]
            mono, bound = head.mode == 3, 12 if bits == "joint" else 32
            n = extra = 0
            for band, w in enumerate(wide):
                for _ in range(1 if mono or band >= bound else 2):
                    used = int(after[n : n + w], 2) > 0
                    n, extra = n + w, extra + 2 * used * (2 if band >= bound and not mono else 1)
            n += extra
        crc = plain_crc(f"{word & 0xFFFF:016b}" + after[:n])
        body[4:6] = crc.to_bytes(2, "big")
        frames.append(bytes(body))
    whole = b"".join(frames)
    found = mpeg_media.scan(whole)
    assert (len(found.offsets), found.bad_checksums, found.skipped) == (3, 0, 0)
    broken = bytearray(whole)
    broken[length + 6] ^= 128
    assert mpeg_media.scan(bytes(broken)).bad_checksums == 1


def test_vbri_tables_and_free_bit_rates():
    word, length = 0xFFF344C4, 96
    first = bytearray(length)
    first[:4] = word.to_bytes(4, "big")
    first[36:62] = b"VBRI" + bytes(6) + (960).to_bytes(4, "big") + (9).to_bytes(4, "big") + (3).to_bytes(2, "big") + (1).to_bytes(2, "big") + (2).to_bytes(2, "big") + (3).to_bytes(2, "big")
    first[62:68] = b"\0\x60\1\x20\1\x20"
    frame = word.to_bytes(4, "big") + bytes(92)
    found = mpeg_media.scan(bytes(first) + frame * 9)
    assert found.table == ("VBRI", 9, 960, b"\0\x60\1\x20\1\x20") and len(found.offsets) == 9 and "table=1" in found.feature()
    free = lambda pad: (0xFFFB0064 | pad << 9).to_bytes(4, "big") + b"\x11" * (996 + pad)
    found = mpeg_media.scan(b"junk" + free(0) + free(1) + free(0) + free(0))
    assert (found.lengths, found.skipped, found.kbps) == ([1000, 1001, 1000, 1000], 4, {0})


def test_tags_of_all_versions():
    stream = mpeg_media.wrap(b"x")
    audio = stream[10 + stream[9] :]
    sync = lambda n: bytes(n >> s & 127 for s in (21, 14, 7, 0))
    old = b"TT2" + (6).to_bytes(3, "big") + b"\0title"
    assert mpeg_media.scan(b"ID3\2\0\0" + sync(len(old)) + old + audio).tags == {"TT2": "title"}
    text = b"\1\xff\xfe" + "naïve".encode("utf-16-le")
    three = (b"TIT2" + len(text).to_bytes(4, "big") + b"\0\0" + text).replace(b"\xff", b"\xff\0")
    found = mpeg_media.scan(b"ID3\3\0\x80" + sync(len(three)) + three + audio)
    assert found.tags == {"TIT2": "naïve"} and len(found.offsets) == 1 and found.skipped == 0
    extended = (6).to_bytes(4, "big") + bytes(6) + b"TIT2" + (3).to_bytes(4, "big") + b"\0\0\0hi"
    assert mpeg_media.scan(b"ID3\3\0\x40" + sync(len(extended)) + extended + audio).tags == {"TIT2": "hi"}


def test_media_table(odd, odd_rows, empty):
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = Counter()
    for i, t in odd_rows:
        raw = (t or "").encode()
        payload = raw.ljust(max(1, -(-len(raw) // 576)) * 576, b"\xff")
        media = mpeg_media.wrap(raw)
        want[i, len(raw), len(payload), sha(payload), zlib.crc32(payload[-32:]), len(media), sha(media)] += 1
    rows = mpeg_media.store_and_read(odd.withColumn("media", F.lit(1))).collect()
    assert Counter(tuple(r)[:7] for r in rows) == want and all(r.n_samples == r.payload_bytes for r in rows)
    by_size = {len((t or "").encode()): plain_parse(mpeg_media.wrap((t or "").encode())) for _, t in odd_rows}
    for r in rows:
        payload, places, right, table, count = by_size[r.n_bytes]
        assert [sum(r.frame_steps[: k + 1]) for k in range(len(r.frame_steps))] == places and r.sample_rate == 16000
        assert r.feature == f"mpeg2-layer3-16000;cbr;frames={len(places)};samples={576 * len(places)};table=1;bad=0;skipped=0;seek={zlib.crc32(b''.join(p.to_bytes(8, 'little') for p in places)):08x}"
    assert mpeg_media.store_and_read(empty).count() == 0


def test_sharded_table(spark, odd, empty):
    root = new_path(spark, "test-sharded")
    given = odd.withColumn("__shard", F.lit("mine")).withColumn("__RUN", F.lit(1)).withColumn("_metadata", F.lit("own")).withColumn("file", F.lit("f"))
    table = compaction.ShardedTable(spark, root, given.schema)
    rows = Counter(tuple(r) for r in given.collect())
    for _ in range(4):  # so that each tier has shards enough
        table.append(given)
    assert table.append(given.limit(0)) == 5
    all_rows = Counter({k: 4 * n for k, n in rows.items()})
    held = lambda v=None: Counter(tuple(r) for r in table.read(v).collect())
    assert held() == all_rows and held(1) == rows
    before = table.manifest().count()
    assert table.compact() and table.version() == 6 and table.manifest().count() < before
    assert held() == all_rows and held(4) == all_rows
    while table.compact():
        pass
    assert not table.compact() and table.vacuum() > 0 and held() == all_rows
    assert table.manifest().agg(F.sum("rows")).first()[0] == sum(all_rows.values())
    with pytest.raises(ValueError, match="not kept"):
        table.read(1)
    table.append(given)
    assert held() == Counter({k: 5 * n for k, n in rows.items()})


def test_a_version_is_committed_once(spark, odd):
    root = new_path(spark, "test-commit")
    one, two = (compaction.ShardedTable(spark, root, odd.schema) for _ in range(2))
    one.append(odd)
    lists = one._names("manifests")
    assert two.version() == 1 and not two._commit(two.manifest(1), 1) and one._names("manifests") == lists and one._names("staging") == []
    assert two._commit(two.manifest(1), 2) and one.version() == 2
    assert compaction.ShardedTable(spark, new_path(spark, "none"), odd.schema).read().count() == 0


def test_vacuum_spares_what_is_not_committed_yet(spark, odd):
    root = new_path(spark, "test-vacuum")
    writer, cleaner = (compaction.ShardedTable(spark, root, odd.schema) for _ in range(2))
    writer.append(odd)
    commit = writer._commit

    def slow(shards, version):
        cleaner.vacuum()  # between a writer's shards and its commit
        return commit(shards, version)

    writer._commit = slow
    assert writer.append(odd) == 2 and writer.read().count() == 2 * odd.count() and writer._names("pending") == []


def test_writers_at_the_same_time_lose_nothing(spark, odd):
    root = new_path(spark, "test-writers")
    small = odd.limit(7).cache()
    n = small.count()
    compaction.ShardedTable(spark, root, odd.schema).append(small)

    def work(k):
        own = compaction.ShardedTable(spark, root, odd.schema)
        own.append(small)
        if k == 0:
            own.compact()
        own.vacuum(keep=8)

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(work, range(3)))
    assert compaction.ShardedTable(spark, root, odd.schema).read().count() == 4 * n


def test_plan_takes_runs_of_a_tier(spark, odd):
    table = compaction.ShardedTable(spark, new_path(spark, "test-plan"), odd.schema, target=1000)
    sizes = [10] * 9 + [100] * 3 + [700] * 8 + [300] * 8
    raw = lambda i, s: 16 * 480 if i in (0, 1) else s  # noqa: E731  two shards are large before compression
    manifest = spark.createDataFrame([(f"f{i}", "d", 28, 1, s, raw(i, s)) for i, s in enumerate(sizes)], compaction.LISTED)
    runs = defaultdict(list)
    for r in table.plan(manifest).collect():
        runs[r.run].append(int(r.file[1:]))
    assert sorted(map(len, runs.values())) == [6] and all(sum(max(sizes[i], raw(i, sizes[i]) // 16) for i in v) <= 1000 for v in runs.values())


RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}


def plain_rule(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [r for r in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])]
    return host, path, max(fits, key=len, default=None)


URLS = [None, "", "no scheme", "http://", "http://A.Example.COM", "http://example.com/en/1?x=/es/", "https://www.example.com/en/", "http://sub.www.example.com/en/x#y", "http://a.net/es/q", "http://a.net/fr", "http://net/fr/", "ftp://xcom/a", "http://ÀB.com/É", "http://h?q=1", "http://h#f", "x://y://z/a", "http://host/a//b/" + "d/" * 30]


def test_urls_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)] + [(0, None, None)], "page_id long, url string, host string")
    got = Counter((r.page_id, r.host, r.path, r.rule) for r in url_templates.judge(pages, spark.createDataFrame([], "page_id long, bad int")).collect())
    assert got == Counter((i, *plain_rule(u)) for i, u in [*enumerate(URLS), (0, None)])
    rows = url_templates.judge(pages, spark.createDataFrame([], "page_id long, bad int")).collect()
    assert all(r.verdict == RULES.get(r.rule, "allow") for r in rows)
    assert url_templates.judge(pages.limit(0), spark.createDataFrame([], "page_id long, bad int")).count() == 0


def test_templates_separate_bad_branches(spark):
    urls, bad = [], []
    for i in range(400):
        for part, share in (("news", 0.0), ("blog", 0.01), ("spam", 0.95), ("ads", 0.94)):
            urls.append(f"http://site.org/{part}/{i * 7 + 13}.html")
            bad.append(int((i % 100) / 100 < share))
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(i, b) for i, b in enumerate(bad) if i % 3], "page_id long, bad int")
    rows = url_templates.judge(pages, labels).collect()
    assert {r.template for r in rows} == {"/{blog+1}/<n.ext>", "/{ads+1}/<n.ext>"}
    assert all((r.verdict == "block") == ("/ads/" in urls[r.page_id] or "/spam/" in urls[r.page_id]) for r in rows)


def plain_rotation(turns, piece_chars=1 << 18):
    """(conv_id, speaker, piece, start, n_turns, n_own, rendered, spans) of every piece, from whole renderings."""
    text_of = lambda x: re.sub(r"<(\\*)\|", r"<\\\1|", x or "")
    name_of = lambda x: re.sub(r"\|(\\*)>", r"|\\\1>", text_of(x))
    out = []
    for c in sorted({c for c, *_ in turns}, key=str):
        own = sorted((t is not None, t or 0, r or "unknown", x or "") for d, t, r, x in turns if d == c)
        heads = ["<|system|>\n" if role == "system" else f"<|user name={name_of(role)}|>\n" for _, _, role, _ in own]
        at, piece = 0, []
        for head, (*_, said) in zip(heads, own, strict=True):
            piece.append(at // piece_chars)
            at += len(head) + len(text_of(said)) + len("<|end|>\n")
        for speaker in sorted({r or "unknown" for d, _, r, _ in turns if d == c} - {"system"}):
            whole, rows = "", {}
            for k, head, (_, _, role, said) in zip(piece, heads, own, strict=True):
                row = rows.setdefault(k, [len(whole), 0, 0, "", []])
                head = "<|assistant|>\n" if role == speaker else head
                begin = len(whole) + len(head)
                shown = head + text_of(said) + "<|end|>\n"
                whole += shown
                row[1], row[3] = row[1] + 1, row[3] + shown
                if role == speaker:
                    row[2] += 1
                    row[4].append(f"{begin}:{len(whole)}")
            out += [(c, speaker, k, start, n, m, text, ",".join(spans)) for k, (start, n, m, text, spans) in rows.items()]
    return Counter(out)


def test_branches_differ_below_many_levels_and_beside_many_siblings(spark):
    deep = "/a/b/c/d/e/f/g/h/i"
    urls = [(f"http://deep.org{deep}/{part}/{k}", int(part == "bad")) for part in ("good", "bad") for k in range(60)]
    urls += [(f"http://wide.org/section{s}/{k}.html", int(s == 7)) for s in range(45) for k in range(30)]
    urls += [(f"http://thin.org/w{chr(97 + k % 26)}{chr(97 + k // 26)}/x", k % 2) for k in range(200)]
    urls += [(f"http://odd.org/<n>/{k}", 1) for k in range(40)] + [(f"http://odd.org/{k}/{k}", 0) for k in range(40)]
    urls += [("http://long.org/" + "/".join(f"s{k}" for k in range(400)), 0)]
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(urls)], "page_id long, url string")
    labels = spark.createDataFrame([(i, b) for i, (_, b) in enumerate(urls)], "page_id long, bad int")
    rows = url_templates.judge(pages, labels).collect()
    by_host = defaultdict(dict)
    for r in rows:
        by_host[r.host].setdefault(r.template, set()).add((r.verdict, urls[r.page_id][1]))
    assert by_host["deep.org"] == {f"{deep}/good/<n>": {("allow", 0)}, f"{deep}/bad/<n>": {("block", 1)}}
    assert by_host["wide.org"] == {"/{section0+43}/<n.ext>": {("allow", 0)}, "/section7/<n.ext>": {("block", 1)}}
    assert list(by_host["thin.org"]) == ["/<word>/<word>"] or list(by_host["thin.org"]) == ["/<word>/x"]
    assert by_host["odd.org"] == {"/=<n>/<n>": {("block", 1)}, "/<n>/<n>": {("allow", 0)}}
    assert [t.count("/") for t in by_host["long.org"]] == [400]


def plain_verdicts(pages, bad, rules):
    """Template and share of every page by dictionaries: (host, path) to (template, share)."""
    wild = [("<n>", r"[0-9]+"), ("<n.ext>", r"[0-9]+\.[A-Za-z0-9]{1,5}"), ("<hex>", r"[0-9a-fA-F-]{8,}"), ("<word>", r"\p{L}+"), ("<slug>", r"[\p{L}\p{N}]+([-_.][\p{L}\p{N}]+)+")]
    kind = lambda s: next((n for n, p in wild if regex.fullmatch(p, s)), "<any>")
    rows = [(i, *plain_rule(u)[:2]) for i, u in pages]
    made = {i: () for i, _, _ in rows}
    segs = {i: [x for x in p.split("/") if x] for i, _, p in rows}
    for level in range(max(map(len, segs.values()))):
        often = Counter((h, made[i], segs[i][level]) for i, h, _ in rows if len(segs[i]) > level)
        made |= {i: (*made[i], "=" + segs[i][level] if often[h, made[i], segs[i][level]] >= 10 else kind(segs[i][level])) for i, h, _ in rows if len(segs[i]) > level}
    branch = dict(made)
    for level in reversed(range(max(map(len, segs.values())))):
        tally = defaultdict(lambda: [0, 0])
        for i, h, _ in rows:
            if len(branch[i]) > level and branch[i][level][0] == "=":
                tally[h, branch[i][:level], branch[i][level + 1 :], branch[i][level]][0] += i in bad
                tally[h, branch[i][:level], branch[i][level + 1 :], branch[i][level]][1] += bad.get(i, 0)
        part, groups = {k: "" for k in tally}, 0
        while len({(k[:3], v) for k, v in part.items()}) > groups:
            groups, pool = len({(k[:3], v) for k, v in part.items()}), defaultdict(lambda: [0, 0])
            for k, (x, b) in tally.items():
                pool[k[:3], part[k]][0] += x
                pool[k[:3], part[k]][1] += b
            after = {}
            for k, (x, b) in tally.items():
                x_all, b_all = pool[k[:3], part[k]]
                n, m = x + 1.0, x_all - x + 1.0
                p, q = (b + 0.5) / n, (b_all - b + 0.5) / m
                both = (p * n + q * m) / (n + m)
                apart = abs(p - q) > 1.96 * (both * (1 - both) * (1 / n + 1 / m)) ** 0.5
                after[k] = part[k] + ("=" if not apart else "+" if p > q else "-")
            part = after
        names = defaultdict(list)
        for k in tally:
            names[k[:3], part[k]].append(k[3])
        for i, h, _ in rows:
            if len(branch[i]) > level and branch[i][level][0] == "=":
                k = (h, branch[i][:level], branch[i][level + 1 :], branch[i][level])
                own = names[k[:3], part[k]]
                branch[i] = (*k[1], f"{{{min(own)[1:]}+{len(own) - 1}}}" if len(own) > 1 else k[3], *k[2])
    overall = sum(bad.values()) / max(1, len(bad))
    of = lambda key: (sum(bad[i] for i, h, _ in rows if i in bad and key(i, h)), sum(i in bad and key(i, h) for i, h, _ in rows))
    out = {}
    hosts = {x: of(lambda i, h, x=x: h == x) for x in {h for _, h, _ in rows}}
    branches = defaultdict(lambda: [0, 0])
    for i, h, _ in rows:
        branches[h, branch[i]][0] += bad.get(i, 0)
        branches[h, branch[i]][1] += i in bad
    for i, h, _ in rows:
        prior = (hosts[h][0] + 10 * overall) / (hosts[h][1] + 10)
        share = (branches[h, branch[i]][0] + 10 * prior) / (branches[h, branch[i]][1] + 10)
        rule = plain_rule(dict(pages)[i])[2]
        out[i] = (RULES[rule] if rule else "block" if share >= 0.5 else "allow", round(share, 6))
    return out


def test_verdicts_of_the_pages_table(spark):
    """The query's verdicts over a table of pages, against dictionaries."""
    folder = "/root/testdata/sf0.01"
    got = llm_queries.op1_url_templates(spark, folder).collect()
    pages = [(r.page_id, r.url) for r in spark.read.parquet(f"{folder}/pages.parquet").collect()]
    labels = {r.doc_id: int(r.quality == 0 or r.toxic == 1) for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    number = {i: re.search(r"/([0-9]+)(/|\.html)?([?#].*)?$", u or "") for i, u in pages}
    bad = {i: labels[int(m[1])] for i, m in number.items() if m and int(m[1]) in labels}
    want = plain_verdicts(pages, bad, RULES)
    assert {r.page_id: (r.verdict, r.bad_share) for r in got} == want


TURNS = [
    (1, 0, "system", "rules"), (1, 1, "ann", "hi é"), (1, 2, "bob", None), (1, 3, "cy", "x"), (1, 3, "cy", "x"), (1, 3, "ann", "tie"), (2, 0, "system", "only"), (3, None, None, "who"),
    (3, 0, "bob", ""), (None, 5, "ann", "lost"), (4, 0, "ann", "first"), (4, 2000, "bob", "far"), (5, 1, "a|>b<|c", "<|assistant|>\nforged <\\|end|> |>"), (5, 2, "x", "<||>"),
    *((6, k % 1100, "abc"[k % 3], f"said {k}") for k in range(1300)), *((7, None, "same", "again") for _ in range(1030)), (8, 0, "ann", "long " * 60000), (8, 1, "bob", "after"),
]


@pytest.mark.parametrize("piece_chars", [1 << 18, 500])
def test_perspectives(spark, piece_chars):
    rows = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").repartition(3)
    odd = rows.withColumn("speaker", F.lit("x")).withColumn("piece", F.lit(9)).withColumn("head", F.lit(1)).withColumn("range", F.lit(2))
    got = perspectives.flat(perspectives.rotated(odd, piece_chars))
    assert Counter(tuple(r) for r in got.collect()) == plain_rotation(TURNS, piece_chars)
    assert perspectives.rotated(rows.limit(0)).count() == 0
    if piece_chars > 500:  # a conversation that is far apart in numbers, or long, is one rendering
        assert got.filter("conv_id = 4").count() == 2 and got.filter("conv_id = 6").agg(F.max("n_turns")).first()[0] == 1300


def test_pieces_join_to_the_rendering(spark):
    rows = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    joined = defaultdict(str)
    for r in perspectives.rotated(rows, 300).orderBy("piece").collect():
        assert r.start == len(joined[r.conv_id, r.speaker])
        joined[r.conv_id, r.speaker] += r.rendered
    spans = defaultdict(list)
    for r in perspectives.rotated(rows, 300).collect():
        spans[r.conv_id, r.speaker] += r.mask_spans
    want = {(c, s): t for c, s, _, _, _, _, t, _ in plain_rotation(TURNS, 1 << 40)}
    assert joined == want
    assert all(joined[k][s.start : s.end].endswith("<|end|>\n") and joined[k][: s.start].endswith("<|assistant|>\n") for k, x in spans.items() for s in x)
