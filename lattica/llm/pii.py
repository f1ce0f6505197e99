"""Surrogates for personal data: keyed, of the same kind and form, and distinct.

An entity is a kind and a canonical form; every mention of it, however it is
punctuated, gets the same surrogate.  A surrogate is drawn from a keyed hash
and an attempt number.  Over all documents, an entity whose surrogate is
already another's, or is itself an entity of the corpus, goes to its next attempt.
Names are known by forms of address, and then found in the whole text.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, materialise

#: Forms of address by gender (f, m, or x for either), before a name and behind one.
TITLES = {
    "Mr": "m", "Mister": "m", "Sir": "m", "Herr": "m", "Herrn": "m", "Monsieur": "m", "Señor": "m", "Sr": "m",
    "Mrs": "f", "Ms": "f", "Miss": "f", "Madam": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Mlle": "f", "Señora": "f", "Señorita": "f", "Sra": "f", "Srta": "f",
    "Dr": "x", "Prof": "x", "г-н": "m", "Господин": "m", "г-жа": "f", "Госпожа": "f", "Κύριος": "m", "Κυρία": "f", "السيد": "m", "السيدة": "f",
}
HONORIFICS = {"さん": "x", "様": "x", "氏": "x", "先生": "x", "女士": "f"}
#: Stems of given names by script.
GIVEN = {
    "latin": "Adrian Albin Anton Augustin Carl Christian Damian Daniel Denis Emil Fabian Florian Gabriel Ivan Josef Justin Karol Leon Lucian Manuel Marcel Martin Michael Paul Raphael Robert Roman Simon Stefan Valentin Vincent Wilhelm".split(),
    "cyrillic": "Александр Богдан Валентин Владислав Драган Зоран Иван Константин Мирослав Милан Роман Руслан Станислав Степан Стефан Ярослав".split(),
    "greek": "Αλέξανδρ Δήμητρ Κύριλλ Μάρκελλ Πέτρ Στέφαν Φίλιππ Χρίστ".split(),
    "arabic": "أمين جميل خالد رشيد سعيد سليم سمير عادل كريم نبيل".split(),
    "han": "明 健 翔 蓮 悠 海 空 光 陽 樹 優 薫".split(),
}
#: Endings of given names by script, of a man's or unknown, and of a woman's; of surnames likewise.
GIVEN_ENDINGS = {"latin": ("", "a"), "cyrillic": ("", "а"), "greek": ("ος", "α"), "arabic": ("", "ة"), "han": ("", "子")}
SURNAME_ENDINGS = {"latin": ("", ""), "cyrillic": ("ов", "ова"), "greek": ("", ""), "arabic": ("", ""), "han": ("", "")}
#: Syllables of made surnames by script.
SYLLABLES = {
    "latin": "ba ber bo cal dan del dor fal fen gar gel hal har ka kel lan lin lor mar mel mor nel nor pel ran ren ros sal ten tor val wen".split(),
    "cyrillic": "ба бер во гал дан дор жал зен кал кел лан лин мар мел мор нел нор пал ран рос сал тен тор фен".split(),
    "greek": "βα γελ δαν δορ καλ κελ λαν λιν μαρ μελ μορ νελ νορ παλ ραν ροσ σαλ τεν τορ φεν".split(),
    "arabic": "با دان رام زين سال شام عار فار كان لام مار نور هاد يام".split(),
    "han": "田 山 川 木 林 森 石 村 井 原 野 島 岡 本 松 竹 藤 谷 沢 橋".split(),
}
#: Alphabets in which letters are replaced.
ALPHABETS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчш", "greek": "αβγδεζηθικλμνξοπρστυφχψω", "arabic": "ابتجحدرزسشصطعفقكلمنهوي", "han": "".join(SYLLABLES["han"])}

_NAME = r"[^\W\d_](?:[^\W\d_]|['’-](?=[^\W\d_]))+"
PATTERN = re.compile(
    r"(?P<email>(?<![\w.+-])[\w.+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,})"
    r"|(?P<iban>(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w))"
    r"|(?P<ipv4>(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<card>(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-]))"
    r"|(?P<phone>(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|(?:1[ .-])?(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}|0\d{1,4}[ /.-]\d{2,4}[ .-]\d{2,4}(?:[ .-]\d{2,4})?)(?![\w-]|\.\d))"
    r"|(?P<secret>(?:(?<== \")|(?<==\")|(?<=: \")|(?<=:\")|(?<== )|(?<==)|(?<=: ))(?:[0-9a-f]{16,}|[0-9A-F]{16,}|(?=[A-Za-z]*\d)(?=\d*[A-Za-z])[A-Za-z0-9_-]{20,}))"
    rf"|(?P<title>(?<!\w)(?:{'|'.join(sorted(map(re.escape, TITLES), key=len, reverse=True))})\.?) (?P<person>{_NAME}(?: {_NAME})?)"
    rf"|(?P<behind>[\u3400-\u9fff]{{1,4}}?)(?P<honorific>{'|'.join(HONORIFICS)})"
)
#: What a text must hold somewhere to be searched at all (RE2).
MAYBE = r"[0-9@]|\b(?:" + "|".join(map(re.escape, TITLES)) + r")\b|г-|Господин|Госпожа|Κυρ|Κύρ|السيد|" + "|".join(HONORIFICS)

#: Most overridden entities that are sent to every worker; beyond it they are joined to the documents.
BROADCAST_OVERRIDES = 50_000
MOST_ATTEMPTS = 64


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def script(text: str) -> str:
    """The script of the first letter; one without its own alphabet here counts as Latin."""
    for c in text:
        if c.isalpha():
            name = unicodedata.name(c, "")
            return next((ours for theirs, ours in (("CYRILLIC", "cyrillic"), ("GREEK", "greek"), ("ARABIC", "arabic"), ("CJK", "han"), ("HIRAGANA", "han"), ("KATAKANA", "han")) if name.startswith(theirs)), "latin")
    return "latin"


def _patterned(text: str) -> Iterator[tuple[int, int, str, str]]:
    """Mentions that a pattern finds; a person's name gives one for each of its words."""
    for m in PATTERN.finditer(text):
        kind = m.lastgroup
        if kind == "honorific":
            yield m.start("behind"), m.end("behind"), "surname-" + HONORIFICS[m["honorific"]], m["behind"]
            continue
        if kind == "person":
            gender = TITLES[m["title"].rstrip(".")]
            named = lambda w: w[0].isupper() or script(w) == "arabic"
            words = list(re.finditer(_NAME, m["person"]))
            words = [w for i, w in enumerate(words) if named(w[0]) and (i == 0 or named(words[0][0]))]
            for i, w in enumerate(words):
                at = m.start("person")
                yield at + w.start(), at + w.end(), ("surname-" if i == len(words) - 1 else "given-") + gender, w[0].casefold()
            continue
        got = m[kind]
        if kind in ("card", "phone", "ssn"):
            digits = re.sub(r"\D", "", got)
            if kind == "card" and not luhn(digits):
                continue
            if kind == "phone":
                if not 7 <= len(digits) <= 15:
                    continue
                # the trunk 1 of a number of ten digits is a way to write it
                digits = digits[1:] if len(digits) == 11 and digits[0] == "1" else digits
            yield m.start(), m.end(), kind, digits
        elif kind == "iban":
            yield m.start(), m.end(), kind, got.replace(" ", "")
        else:
            yield m.start(), m.end(), kind, got.casefold() if kind == "email" else got


def find(text: str) -> list[tuple[int, int, str, str]]:
    """Mentions: begin, end, kind, canonical form; in order, none over another.

    Kinds of names are ``given-m``, ``given-f``, ``given-x`` and ``surname-<gender>``.
    A name that stands with a form of address somewhere is found in the whole
    text, where it is a capitalised word of its own, and has one gender in it:
    the one that a form of address tells.
    """
    found = list(_patterned(text))
    names: dict[str, str] = {}
    for _, _, kind, canonical in found:
        if kind.startswith(("given-", "surname-")):
            known = names.get(canonical, kind)
            # a title that tells the gender counts before one that does not
            names[canonical] = kind if known.endswith("-x") and known.split("-")[0] == kind.split("-")[0] else known
    if not names:
        return found
    taken = [(a, b) for a, b, _, _ in found]
    bare = []
    for m in re.finditer(_NAME, text):
        if m[0].casefold() in names and (m[0][0].isupper() or script(m[0]) == "arabic"):
            at = bisect.bisect_right(taken, (m.start(), len(text)))
            if (not at or taken[at - 1][1] <= m.start()) and (at == len(taken) or taken[at][0] >= m.end()):
                bare.append((m.start(), m.end(), names[m[0].casefold()], m[0].casefold()))
    told = [(a, b, names[c] if k.startswith("given-") and names[c].startswith("given-") else k, c) for a, b, k, c in found]
    return sorted(told + bare)


class Stream:
    """Numbers drawn from a keyed hash of (kind, canonical form, attempt)."""

    def __init__(self, key: bytes, kind: str, canonical: str, attempt: int):
        self.args, self.left, self.turn = (key, f"{kind}\0{canonical}\0{attempt}".encode()), 0, 0
        self.value = 0

    def below(self, n: int) -> int:
        if self.left < 1 << 64:
            more = hashlib.blake2b(self.args[1] + self.turn.to_bytes(4, "big"), key=self.args[0], digest_size=32).digest()
            self.value, self.left, self.turn = int.from_bytes(more, "big"), 1 << 256, self.turn + 1
        self.value, got = divmod(self.value, n)
        self.left //= n
        return got


def _like(text: str, s: Stream) -> str:
    """Letters for letters of the same script and case, digits for digits; the rest stays."""
    out = []
    for c in text:
        if c.isdigit():
            out.append(str(s.below(10)))
        elif c.isalpha():
            letters = ALPHABETS[script(c)]
            new = letters[s.below(len(letters))]
            out.append(new.upper() if c.isupper() else new)
        else:
            out.append(c)
    return "".join(out)


def surrogate(kind: str, canonical: str, key: bytes, attempt: int = 0) -> str:
    """The canonical form that takes the place of ``canonical``."""
    s = Stream(key, _pool(kind), canonical, attempt)
    if kind == "email":
        local, _, domain = canonical.partition("@")
        head = domain.rsplit(".", 2)[0] if domain.count(".") >= 2 else domain.split(".")[0]
        return f"{_like(local, s)}@{_like(head, s).strip('-') or 'mail'}.example.{('com', 'net', 'org')[s.below(3)]}"
    if kind == "ipv4":
        first = int(canonical.split(".")[0])
        # private stays private
        head = [10] if first == 10 else [192, 168] if canonical.startswith("192.168.") else [(11 + s.below(89))]
        return ".".join(map(str, [*head, *(s.below(256) for _ in range(3 - len(head))), 1 + s.below(254)]))
    if kind == "card":
        body = canonical[0] + "".join(str(s.below(10)) for _ in canonical[1:-1])
        return body + next(c for c in "0123456789" if luhn(body + c))
    if kind == "ssn":
        return f"{9}{s.below(100):02d}{1 + s.below(99):02d}{1 + s.below(9999):04d}"
    if kind == "phone":
        keep = max(0, len(canonical) - 10)
        area = str(2 + s.below(8)) if len(canonical) - keep else ""
        return canonical[:keep] + area + "".join(str(s.below(10)) for _ in range(len(canonical) - keep - 1))
    if kind == "iban":
        body = _like(canonical[4:], s)
        number = "".join(str(int(c, 36)) for c in body + canonical[:2]) + "00"
        return f"{canonical[:2]}{98 - int(number) % 97:02d}{body}"
    if kind == "secret":
        if re.fullmatch(r"[0-9a-fA-F]+", canonical):
            alphabet = "0123456789ABCDEF" if canonical.isupper() else "0123456789abcdef"
            return "".join(alphabet[s.below(16)] for _ in canonical)
        return _like(canonical, s)
    written = script(canonical)
    if _pool(kind) == "given":
        # after the first attempt two stems joined, and one more every two attempts: the domain never runs dry
        stems = [GIVEN[written][s.below(len(GIVEN[written]))] for _ in range((attempt + 3) // 2)]
        return "-".join(stem + GIVEN_ENDINGS[written][0] for stem in stems).casefold()
    parts = SYLLABLES[written]
    few = 2 if written == "han" else 3
    return "".join(parts[s.below(len(parts))] for _ in range(few + attempt // 4)) + SURNAME_ENDINGS[written][0]


def _of_woman(kind: str, canonical: str) -> str:
    """A surrogate name with the endings of a woman's."""
    old, new = (GIVEN_ENDINGS if kind.startswith("given") else SURNAME_ENDINGS)[script(canonical)]
    return "-".join(p[: len(p) - len(old)] + new for p in canonical.split("-"))


def render(kind: str, mention: str, canonical: str) -> str:
    """The canonical surrogate in the form of the mention: its punctuation, its capitals, its gender ending."""
    if kind in ("card", "phone", "ssn"):
        # leading digits that the canonical form lacks stay
        digits = iter([None] * (sum(c.isdigit() for c in mention) - len(canonical)) + list(canonical))
        return "".join((next(digits, None) or c) if c.isdigit() else c for c in mention)
    if kind == "iban":
        if " " in mention:
            return " ".join(canonical[i : i + 4] for i in range(0, len(canonical), 4))
        return canonical
    if kind == "email":
        return canonical.upper() if mention.isupper() else canonical
    if kind.startswith(("given", "surname")):
        if kind.endswith("-f"):
            canonical = _of_woman(kind, canonical)
        return canonical.upper() if mention.isupper() and len(mention) > 1 else "-".join(p.capitalize() for p in canonical.split("-"))
    return canonical


def _pool(kind: str) -> str:
    """Kinds among which surrogates must differ: a name has one surrogate, whatever the title."""
    return kind.split("-")[0] if kind.startswith(("given", "surname")) else kind


def _text_key(text_col: str):
    """What texts and their entities are joined by; texts that share it share the union of their entities, which is harmless."""
    return F.xxhash64(F.col(text_col).cast("string"))


def entities(docs: DataFrame, text_col: str) -> DataFrame:
    """text_key, pool, canonical: one row for each text and entity."""
    arrow_rows(docs.sparkSession)

    def run(batches):
        for batch in batches:
            found = pc.fill_null(pc.match_substring_regex(batch.column(1), MAYBE), False)
            rows = batch.filter(found)
            keys, pools, names = [], [], []
            for text_key, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                for pool, name in dict.fromkeys((_pool(kind), canonical) for _, _, kind, canonical in find(text)):
                    keys.append(text_key)
                    pools.append(pool)
                    names.append(name)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(pools, pa.string()), pa.array(names, pa.string())], ["text_key", "pool", "canonical"])

    source = docs.select(_text_key(text_col).alias("text_key"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, "text_key long, pool string, canonical string")


def settle(found: DataFrame, key: bytes) -> DataFrame:
    """pool, canonical, attempt of every entity, so that no surrogate is shared or is itself an entity.

    ``found``: distinct pool and canonical.  Each round tries one attempt for
    those not settled; of those with one surrogate the smallest canonical form
    keeps it.
    """

    def attempt(n: int):
        def run(batches):
            for batch in batches:
                pools, names = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                made = [surrogate(p, c, key, n) for p, c in zip(pools, names, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.string())], ["pool", "canonical", "made"])

        return run

    # names that a surrogate would be with a woman's ending, as the surrogate itself is written
    stems = F.col("canonical")
    for given, surname in zip(GIVEN_ENDINGS.values(), SURNAME_ENDINGS.values(), strict=True):
        for pool, (man, woman) in (("given", given), ("surname", surname)):
            if woman:
                stems = F.when((F.col("pool") == pool) & F.col("canonical").rlike(f"{woman}$"), F.regexp_replace("canonical", f"{woman}(?=-|$)", man)).otherwise(stems)
    womens = found.where(F.col("pool").isin("given", "surname")).select("pool", stems.alias("made")).distinct()
    settled, left = None, found
    for n in range(MOST_ATTEMPTS):
        tried = left.select("pool", "canonical").mapInArrow(attempt(n), "pool string, canonical string, made string")
        firsts = tried.groupBy("pool", "made").agg(F.min("canonical").alias("canonical"))
        taken = found.select("pool", F.col("canonical").alias("made")).unionByName(womens)
        if settled is not None:
            taken = taken.unionByName(settled.select("pool", "made"))
        good = firsts.join(taken, ["pool", "made"], "left_anti").select("pool", "canonical", "made", F.lit(n).alias("attempt"))
        good = materialise(good, "pii-settled")
        settled = good if settled is None else settled.unionByName(good)
        left = materialise(left.join(good, ["pool", "canonical"], "left_anti"), "pii-left")
        if left.isEmpty():
            return settled
    raise RuntimeError(f"entities without a surrogate of their own after {MOST_ATTEMPTS} attempts")


def replace_pii(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with every detected entity replaced; all columns and rows stay.

    ``key``: the secret of the surrogates; the same key and corpus give the same
    texts.  ``count_col``: if given, a column with the number of replaced
    mentions.  Null texts stay null and count 0; empty texts, repeated rows and
    repeated or null ids are no special case.  No rows in: no rows out.  A
    column that is already called ``count_col`` is replaced.

    Texts are not shuffled while the entities that needed another attempt are
    at most ``BROADCAST_OVERRIDES``; beyond it they are joined to the documents
    by a hash of the text, so ``id_col`` plays no part.
    """
    found = materialise(entities(docs, text_col), "pii-found")
    settled = settle(materialise(found.select("pool", "canonical").distinct(), "pii-entities"), key)
    over = settled.where(F.col("attempt") > 0).select("pool", "canonical", "attempt")
    columns = [c for c in docs.columns if c != count_col]
    schema = docs.select(*columns).schema
    for extra in ([count_col] if count_col else []):
        schema = schema.add(extra, "long")
    out_names = [f.name for f in schema]
    at = columns.index(text_col)

    def rewrite(known: dict | None):
        def run(batches):
            memory: dict = {}
            for batch in batches:
                texts = batch.column(at)
                flags = pc.fill_null(pc.match_substring_regex(pc.cast(texts, pa.string()), MAYBE), False).to_numpy(zero_copy_only=False)
                own = batch.column(batch.num_columns - 1).to_pylist() if known is None else None
                counts = [0] * batch.num_rows
                new = texts.to_pylist() if flags.any() else None
                for i in flags.nonzero()[0].tolist():
                    attempts = known if own is None else {(o["pool"], o["canonical"]): o["attempt"] for o in own[i] or ()}
                    text, parts, last = new[i], [], 0
                    for a, b, kind, canonical in find(text):
                        which = (kind, canonical, attempts.get((_pool(kind), canonical), 0))
                        if which not in memory:
                            if len(memory) > 100_000:
                                memory.clear()
                            memory[which] = surrogate(_pool(kind), canonical, key, which[2])
                        parts += [text[last:a], render(kind, text[a:b], memory[which])]
                        last = b
                        counts[i] += 1
                    if parts:
                        new[i] = "".join([*parts, text[last:]])
                made = list(batch.columns[: len(columns)])
                if new is not None:
                    made[at] = pa.array(new, texts.type)
                yield pa.RecordBatch.from_arrays(made + ([pa.array(counts, pa.int64())] if count_col else []), out_names)

        return run

    source = docs.select(*columns)
    rows = over.limit(BROADCAST_OVERRIDES + 1).collect()
    if len(rows) <= BROADCAST_OVERRIDES:
        return source.mapInArrow(rewrite({(r["pool"], r["canonical"]): r["attempt"] for r in rows}), schema)
    per_text = found.join(over, ["pool", "canonical"]).groupBy(F.col("text_key").alias("__key")).agg(F.collect_set(F.struct("pool", "canonical", "attempt")).alias("__own"))
    # texts that hold nothing to replace, null and empty ones among them, stay where they are
    asks = F.coalesce(F.col(text_col).cast("string").rlike(MAYBE.replace(r"\b", "")), F.lit(False))
    joined = source.where(asks).join(per_text, _text_key(text_col) == F.col("__key"), "left").select(*[source[c] for c in columns], "__own")
    rest = source.where(~asks).withColumn("__own", F.lit(None).cast(per_text.schema["__own"].dataType))
    return joined.unionByName(rest).mapInArrow(rewrite(None), schema)
