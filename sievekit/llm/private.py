"""Personal data: detection and keyed, type-consistent surrogates (operator 5).

Detected entities (mail addresses, phone numbers, network addresses, card
numbers, account and social numbers, titled names) are replaced by surrogates of
the same type, script and format: digits stay digits, separators and domains'
shape stay, card numbers keep their checksum property, names keep their gender
and letter case.  A surrogate depends only on the key and the normalised
entity, so one entity gets one surrogate everywhere (coreference).  Distinct
entities keep distinct surrogates: the surrogates of all distinct entities are
compared in Spark, and every entity but the smallest of a colliding group draws
again with a higher round number, as does one whose surrogate is itself a
detected entity, until no collision is left.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import BLOCKS_A_STAGE, free_prefix, stored, trimmed

KINDS = ("email", "ipv4", "ipv6", "card", "iban", "ssn", "phone", "name")

# fixed values: detectors, in order of precedence where they overlap
_EMAIL = r"(?<![\w.+-])[\w][\w.+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
_IPV4 = r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)"
# eight groups, or fewer around one "::" (four at least, so that times and ratios aren't taken)
_IPV6 = (r"(?<![\w:])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
         r"|(?=(?:[0-9A-Fa-f]{1,4}:{1,2}){3}[0-9A-Fa-f])(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\w:])")
_CARD = r"(?<![\w.])\d{4}(?:[ -]?\d{4}){2}[ -]?\d{3,4}(?:\d{3})?(?!\w)"
_IBAN = r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"
_SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
# phone numbers: +1, French pairs, Spanish groups, any country code, German and other trunk numbers, and short groups;
# exact national forms come first, so that a number after them isn't taken along
_PHONE = (r"(?<![\w.])(?:"
          r"\+1[^\w\s(]{0,3}[ .-]?(?:\(\d{3}\)[^\w\s]{0,3}[ .-]?|\d{3}[ .-])\d{3}[ .-]?\d{4}"
          r"|(?:(?:\+|00)33[ ./-]?(?:\(0\)[ ./-]?)?[1-9](?:[ ./-]?\d{2}){4}|0[1-9](?:(?: \d{2}){4}|(?:\.\d{2}){4}|(?:-\d{2}){4}|(?:/\d{2}){4}))"
          r"|(?:(?:\+|00)34[ ./-]?)?[6-9](?:\d{2}(?:[ ./-]\d{2}){3}|\d[ ./-]\d{3}(?:[ ./-]\d{2}){2})"
          r"|(?=(?:[+ ./()-]{0,3}\d){8})(?:\+|00)[1-9]\d{0,3}(?:(?:[ ./-]|[ ./-]?\(\d{1,5}\)[ ./-]?)\d{1,12}){1,7}"
          r"|(?=(?:[ ./-]?\d){9})(?!\d\d[./-]\d\d[./-](?:\d\d)?\d\d(?!\d|[./-]\d))0[1-9]\d{0,4}[ ./-](?:\d{5,8}|\d{2,4}(?:(?: \d{2,4}){1,4}|(?:-\d{2,4}){1,4}|(?:\.\d{2,4}){1,4}))"
          r"|0[1-9]\d{1,4}/\d{5,8}"
          r"|\+\d{1,3}[^\w\s(]{0,3}[ .-]?(?:\(\d{2,4}\)[^\w\s]{0,3}[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]?\d{3,4}"
          # without a country code: brackets, dashes or dots, or groups of 3, 3 and 4; blanks alone may part any numbers
          r"|(?:\(\d{2,4}\)[^\w\s]{0,3}[ .-]?|\d{2,4}[.-])\d{3,4}[ .-]?\d{3,4}|\d{3} \d{3}[ .-]\d{4}"
          r"|\+\d{8,15}"
          r")(?!\w|\.\d)")
_TITLED = (r"(?<!\w)(?:Mr|Mrs|Ms|Miss|Herr|Frau|Monsieur|Madame|Mme|Señora|Señor|Sra|Sr|Dr|Prof|"
           r"Господин|Госпожа|г-н|г-жа|Κύριος|Κυρία)\.? ")
_UPPER = "[A-ZÀ-ÖØ-ÞΑ-ΫА-ЯЁІЇЄ]"
_NAME = _TITLED + _UPPER + r"[\w'’-]+(?: " + _UPPER + r"[\w'’-]+)?"
_FIND = re.compile("|".join(f"(?P<{k}>{p})" for k, p in zip(
    KINDS, (_EMAIL, _IPV4, _IPV6, _CARD, _IBAN, _SSN, _PHONE, _NAME), strict=True)))

# every other kind has a digit, an @ or two colons
_MAY_HOLD = re.compile(rf"[\d@]|::|{_TITLED}")

# fixed values: surrogate names by gender
GIVEN = {"m": ("Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Gustav", "Hugo", "Ivan", "Jonas", "Karl", "Leon",
               "Martin", "Nils", "Oskar", "Paul"),
         "f": ("Anna", "Berta", "Clara", "Diana", "Emma", "Flora", "Greta", "Hanna", "Irene", "Julia", "Klara", "Laura",
               "Maria", "Nora", "Olga", "Paula")}
# fixed values: syllables of surrogate family names by script
SYLLABLES = {"latin": ("ba", "den", "fal", "gor", "hal", "kin", "lor", "men", "nor", "pel", "ran", "sol", "tor", "ver", "wen", "zan"),
             "greek": ("βα", "γορ", "δεν", "ζαν", "θελ", "κιν", "λορ", "μεν", "νορ", "παλ", "ραν", "σολ", "τορ", "φερ", "χαλ", "ψιν"),
             "cyrillic": ("ба", "вер", "гор", "ден", "зан", "кин", "лор", "мен", "нор", "пал", "ран", "сол", "тор", "фел", "хал", "шин")}
GIVEN_OTHER = {"greek": {"m": ("Νίκος", "Γιώργος", "Πέτρος", "Λουκάς"), "f": ("Άννα", "Μαρία", "Ελένη", "Σοφία")},
               "cyrillic": {"m": ("Антон", "Борис", "Виктор", "Игорь"), "f": ("Анна", "Вера", "Ирина", "Ольга")}}
_MALE = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин", "г-н", "Κύριος")
_NEUTRAL = ("Dr", "Prof")


def script_of(word: str) -> str:
    """The script of a word's first letter: greek, cyrillic or latin."""
    c = ord(word[0]) if word else 0
    return "greek" if 0x370 <= c < 0x400 else "cyrillic" if 0x400 <= c < 0x530 else "latin"


def entities(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of each entity, left to right, without overlaps."""
    out: list[tuple[int, int, str]] = []
    if not _MAY_HOLD.search(text):
        return out
    at = 0
    while m := _FIND.search(text, at):
        start, at = m.span()
        if m.lastgroup == "phone":
            while sum(c.isdigit() for c in text[start:at]) > 15:
                # groups beyond the longest number belong to something else
                at = start + re.search(r"[^\d]+\d*$", text[start:at]).start()
        elif m.lastgroup == "name":
            # a possessive belongs to the text
            at = start + len(re.sub(r"['’][sS]?$", "", text[start:at]))
        out.append((start, at, m.lastgroup))
    return out


def canonical(kind: str, entity: str) -> str:
    """One spelling for the spellings that name the same thing."""
    if kind == "email":
        return entity.lower()
    if kind in ("card", "iban", "ssn"):
        return re.sub(r"[ -]", "", entity)
    if kind == "phone":
        return re.sub(r"[^\d+]", "", entity)
    if kind == "name":
        return re.sub(r"\s+", " ", entity.replace(".", ""))
    if kind == "ipv6":
        return str(ipaddress.IPv6Address(entity)) if _is_ipv6(entity) else entity.lower()
    return entity


def _is_ipv6(text: str) -> bool:
    try:
        return bool(ipaddress.IPv6Address(text))
    except ValueError:
        return False


def named(text: str, found: list[tuple[int, int, str]]) -> list[tuple[str, str]]:
    """(kind, canonical entity) of each entity of a text.  A title and family name alone stand for
    the one fuller name of that title and family in the text, if there is exactly one."""
    out = [(k, canonical(k, text[s:e])) for s, e, k in found]
    full: dict[tuple[str, str], set[str]] = {}
    for k, x in out:
        words = x.split(" ")
        if k == "name" and len(words) == 3:
            full.setdefault((words[0], words[2]), set()).add(x)
    for i, (k, x) in enumerate(out):
        fuller = full.get(tuple(x.split(" "))) if k == "name" else None
        if fuller and len(fuller) == 1:
            out[i] = (k, next(iter(fuller)))
    return out


class _Draw:
    """Keyed pseudo-random numbers for one entity and round."""

    def __init__(self, key: bytes, kind: str, entity: str, turn: int):
        self.key, self.seed, self.block, self.pool = key, f"{kind}\0{entity}\0{turn}".encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self.pool) < 4:
            self.pool += hmac.new(self.key, self.seed + self.block.to_bytes(4, "big"), hashlib.sha256).digest()
            self.block += 1
        v, self.pool = int.from_bytes(self.pool[:4], "big"), self.pool[4:]
        return v % n


def luhn(digits: str) -> int:
    """The checksum of a card number modulo 10 (0 for valid numbers)."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10


def _same_shape(entity: str, draw: _Draw, keep: int = 0) -> str:
    """Digits for digits and letters for letters of the same case and script, the rest as it is."""
    out = []
    for i, c in enumerate(entity):
        if i < keep:
            out.append(c)
        elif c.isdecimal():
            zero = ord(c) - int(c)
            out.append(chr(zero + draw.below(10)))
        elif "a" <= c <= "z":
            out.append(chr(97 + draw.below(26)))
        elif "A" <= c <= "Z":
            out.append(chr(65 + draw.below(26)))
        elif c.isalpha():
            # another letter of the same block of 16, if that is one of the same case
            near = chr((ord(c) & ~15) + draw.below(16))
            out.append(near if near.isalpha() and near.islower() == c.islower() else c)
        else:
            out.append(c)
    return "".join(out)


def surrogate(key: bytes, kind: str, entity: str, turn: int = 0) -> str:
    """The surrogate of a canonical entity in a drawing round; same type, script and format."""
    draw = _Draw(key, kind, entity, turn)
    if kind == "email":
        user, _, host = entity.partition("@")
        return f"{_same_shape(user, draw)}{draw.below(10**6) if turn > 3 else ''}@mail{draw.below(10**6)}.example.{('com', 'net', 'org')[draw.below(3)]}"
    if kind == "ipv4":
        return f"{1 + draw.below(126)}." + ".".join(str(draw.below(256)) for _ in range(3))
    if kind == "card":
        digits = entity[0] + "".join(str(draw.below(10)) for _ in entity[1:])
        if luhn(entity) == 0:
            digits = next(digits[:-1] + str(d) for d in range(10) if luhn(digits[:-1] + str(d)) == 0)
        return digits
    if kind == "iban":
        return entity[:2] + _same_shape(entity[2:], draw)
    if kind == "ssn":
        return f"{draw.below(10**9):09d}"
    if kind == "phone":
        keep = 2 if entity.startswith("+") else int(entity.startswith("0"))
        return _same_shape(entity, draw, keep)
    if kind == "ipv6":
        return str(ipaddress.IPv6Address((0x20010DB8 << 96) | int.from_bytes(hmac.new(key, f"6\0{entity}\0{turn}".encode(), hashlib.sha256).digest()[:12], "big")))
    title, *rest = entity.split(" ")
    script = script_of(rest[-1]) if rest else "latin"
    lists = GIVEN_OTHER.get(script, GIVEN)
    given = lists["m"] + lists["f"] if title in _NEUTRAL else lists["m" if title in _MALE else "f"]
    family = "".join(SYLLABLES[script][draw.below(16)] for _ in range(3 + turn // 4)).capitalize()
    return " ".join([title, *([given[draw.below(len(given))]] if len(rest) > 1 else []), family])


def in_format(kind: str, original: str, substitute: str) -> str:
    """The surrogate written as this occurrence was: its separators, case and title's dot."""
    if kind in ("card", "iban", "ssn", "phone"):
        marks = "+" if kind == "phone" else ""
        chars = iter(substitute.replace("+", "") if marks else substitute)
        return "".join(next(chars) if c.isalnum() else c for c in original)
    if kind == "name":
        title, _, rest = substitute.partition(" ")
        if len(canonical(kind, original).split(" ")) == 2:
            rest = rest.rpartition(" ")[2]      # the family name alone, also of a fuller name
        dot = "." if original[len(title):len(title) + 1] == "." else ""
        if original.split(" ", 1)[-1].isupper():
            rest = rest.upper()
        return f"{title}{dot} {rest}"
    if kind == "email" and original.isupper():
        return substitute.upper()
    return substitute


def entity_table(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Distinct (kind, entity) of all texts; entities repeat across partitions only before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {x for v in batch.column(0) if (t := v.as_py()) for x in named(t, entities(t))}
            kinds, ents = zip(*sorted(found), strict=True) if found else ((), ())
            yield pa.record_batch([pa.array(kinds, pa.string()), pa.array(ents, pa.string())], names=["kind", "entity"])

    return (docs.select(F.col(f"`{text_col}`").cast("string").alias("text"))
            .mapInArrow(trimmed(run), "kind string, entity string").distinct())


def settled_turns(found: DataFrame, key: bytes, rounds: int = 40) -> DataFrame:
    """(kind, entity, turn) for entities whose first draw collides; the others have turn 0.

    Each round draws for the open entities only, compares surrogates by grouping
    and repeats for the losers; the losers of a round are a small share of it.
    """
    import pandas as pd
    from pyspark.sql.types import StringType

    @F.pandas_udf(StringType())
    def draw(kind, entity, turn):
        return pd.Series([surrogate(key, k, e, int(t)) for k, e, t in zip(kind, entity, turn, strict=True)], dtype=object)

    found = stored(found)       # read again in every round
    now = stored(found.withColumn("turn", F.lit(0)).withColumn("drawn", draw("kind", "entity", F.lit(0))))
    for _ in range(rounds):
        best = now.groupBy("kind", "drawn").agg(F.min("entity").alias("first"), F.count("*").alias("n")).where("n > 1")
        clash = (now.join(best, ["kind", "drawn"]).where("entity <> first").select("kind", "entity")
                 .union(now.join(found.select("kind", F.col("entity").alias("drawn")), ["kind", "drawn"], "left_semi")
                        .select("kind", "entity")).distinct())
        clash = stored(clash)
        if clash.isEmpty():
            return now
        again = (now.join(clash, ["kind", "entity"], "left_semi").select("kind", "entity", (F.col("turn") + 1).alias("turn"))
                 .withColumn("drawn", draw("kind", "entity", "turn")))
        now = stored(now.join(clash, ["kind", "entity"], "left_anti").select("kind", "entity", "turn", "drawn").union(again))
    raise RuntimeError("surrogates still collide")


def _replaced(text: str, found: list[tuple[int, int, str]], key: bytes, turns: list[int]) -> str:
    out, at = [], 0
    for (s, e, k), (_, entity), t in zip(found, named(text, found), turns, strict=True):
        out += [text[at:s], in_format(k, text[s:e], surrogate(key, k, entity, t))]
        at = e
    return "".join([*out, text[at:]])


def _apply(key: bytes, turns, last: bool, prefix: str):
    """Note the turns of one block of the collision table; the last pass writes the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, noted, count, spans = [], [], [], []
            for t, old in zip(batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
                found = entities(t) if t else []
                now = [max(o, turns.value.get(x, 0)) for x, o in zip(named(t, found) if found else [], old or [0] * len(found), strict=True)]
                noted.append(now)
                count.append(len(found))
                if last:
                    texts.append(_replaced(t, found, key, now) if found else t)
                    spans.append(",".join(f"{k}:{s}:{e}" for s, e, k in found))
            rest = list(batch.columns[:-2])
            names = batch.schema.names[:-2]
            if last:
                yield pa.record_batch([*rest, pa.array(texts, pa.string()), pa.array(count, pa.int64()), pa.array(spans, pa.string())],
                                      names=[*names, "text", f"{prefix}n_entities", f"{prefix}entities"])
            else:
                yield pa.record_batch([*rest, batch.column(batch.num_columns - 2), pa.array(noted, pa.list_(pa.int32()))],
                                      names=batch.schema.names)

    return run


#: entries of the collision table that are broadcast at a time
TURNS_AT_ONCE = 200_000


def with_surrogates(docs: DataFrame, key: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
                    turns_at_once: int = TURNS_AT_ONCE, prefix: str = "") -> DataFrame:
    """The ``keep`` columns, ``text`` with surrogates, and ``n_entities`` and ``entities``
    (kind:start:end in the original), the last two named with ``prefix``, of every row.

    Null texts stay null with no entities and an empty list; ids may be null or
    repeat; one entity has one surrogate in all rows; an empty table gives no
    rows.  Only entities whose draws collided are broadcast, in blocks of
    ``turns_at_once``; each block is a narrow pass over the same rows, and rows are
    written after ``BLOCKS_A_STAGE`` of them, so a task never holds more blocks than that.
    """
    secret = key.encode()
    turns = settled_turns(entity_table(docs, text_col), secret).where("turn > 0")
    total = turns.count()
    blocks = max(1, -(-total // turns_at_once))
    kept = [F.col(f"`{c}`") for c in keep]
    p = free_prefix(list(keep), ("text", "turns"))
    now = docs.select(*kept, F.col(f"`{text_col}`").cast("string").alias(p + "text"), F.lit(None).cast("array<int>").alias(p + "turns"))
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    done = StructType([*now.schema.fields[:-2], StructField("text", StringType()), StructField(f"{prefix}n_entities", LongType()),
                       StructField(f"{prefix}entities", StringType())])
    for b in range(blocks):
        rows = turns.where(F.pmod(F.xxhash64("kind", "entity"), F.lit(blocks)) == b).collect() if total else []
        table = docs.sparkSession.sparkContext.broadcast({(r["kind"], r["entity"]): r["turn"] for r in rows})
        last = b == blocks - 1
        now = now.mapInArrow(trimmed(_apply(secret, table, last, prefix)), done if last else now.schema)
        if not last and (b + 1) % BLOCKS_A_STAGE == 0:
            now = stored(now)
    return now
