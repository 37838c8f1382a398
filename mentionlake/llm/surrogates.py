"""Personal data replaced by keyed surrogates that keep type, format, script and gender.

The surrogate of an entity depends on the key and the entity alone, so one name or number
gets one surrogate wherever it occurs, however it is spelt; family and given names are
entities of their own. Persons are found behind a title. Two entities that would share one, or a
surrogate that is itself an entity of the corpus, are told apart by further attempts
until none is left; only the entities on a later attempt are ever joined back.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mentionlake.llm.hashing import pieces
from mentionlake.llm.stage import new_folder, staged
from mentionlake.operators.sizing import broadcast_if_small

# Given names by gender and script, family names by script.
GIVEN = {
    ("f", "latin"): "Anna Clara Emma Julia Laura Maria Nora Paula Sofia Helena Alice Irene Lucia Marta Elena Teresa".split(),
    ("m", "latin"): "Adam Bruno Carl David Felix Hugo Jonas Leon Martin Oscar Paul Simon Thomas Victor Daniel Peter".split(),
    ("f", "cyrillic"): "Анна Мария Ольга Елена Ирина Нина Вера Софья".split(),
    ("m", "cyrillic"): "Иван Павел Олег Антон Игорь Сергей Виктор Борис".split(),
    ("f", "greek"): "Μαρία Ελένη Άννα Σοφία Ειρήνη Κατερίνα".split(),
    ("m", "greek"): "Γιώργος Νίκος Πέτρος Ανδρέας Παύλος Σπύρος".split(),
}
FAMILY = {
    "latin": "Abbott Becker Castro Dubois Evans Fischer Garcia Hansen Ivers Jansen Keller Lopez Moreau Novak Olsen Perez Quinn Roux Silva Turner Ulrich Vidal Weber Young Zimmer".split(),
    "cyrillic": "Иванов Петров Соколов Волков Зайцев Орлов Киселёв Фомин".split(),
    "greek": "Παππάς Νικολάου Γεωργίου Δημητρίου Ιωάννου Βασιλείου".split(),
}
#: Titles and their gender; ``n`` where the title has none.
TITLES = {
    "Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Mister": "m", "Sir": "m", "Dr": "n", "Prof": "n", "Professor": "n", "Doctor": "n",
    "Herr": "m", "Frau": "f", "Monsieur": "m", "Madame": "f", "Mme": "f", "Mlle": "f", "Señor": "m", "Señora": "f", "Sr": "m", "Sra": "f",
    "Signor": "m", "Signora": "f", "Senhor": "m", "Senhora": "f",
    "господин": "m", "Господин": "m", "госпожа": "f", "Госпожа": "f", "г-н": "m", "Г-н": "m", "г-жа": "f", "Г-жа": "f", "доктор": "n", "профессор": "n",
    "κύριος": "m", "Κύριος": "m", "κυρία": "f", "Κυρία": "f", "δρ": "n", "Δρ": "n", "κος": "m", "κα": "f",
}
#: International calling codes of one and two digits; all others have three.
CALLING_CODES = {"1", "7"} | set(
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()
)
_NAME = r"[^\W\d_]+(?:-[^\W\d_]+)?"
#: Kinds in order of precedence where detections overlap.
PATTERNS = (
    ("email", r"(?<![\w.+-])[\w.+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24}(?![\w-])"),
    ("secret", r"(?<![0-9A-Za-z])(?:(?=[0-9a-f]*[a-f])(?=[0-9a-f]*[0-9])[0-9a-f]{32,128}|(?:sk|pk|ghp|AKIA)[_-]?[0-9A-Za-z]{16,64})(?![0-9A-Za-z])"),
    ("iban", r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])"),
    ("ip", r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d.]*\d)"),
    ("card", r"(?<![\d+.-])\d(?:[ -]?\d){12,18}(?![\d-]*\d)"),
    ("ssn", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]*\d)"),
    ("phone", r"(?<![\w+.-])(?:\+\d{1,3}[ .-]?)?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]\d{2,4}){1,4}(?![\w-]*\d)|(?<![\w+.-])\+?\d{9,12}(?!\w)"),
    ("person", rf"\b(?:{'|'.join(sorted(TITLES, key=len, reverse=True))})\.? {_NAME}(?: {_NAME})?"),
)
_FOUND = re.compile("|".join(f"(?P<{k}>{p})" for k, p in PATTERNS))
_HINT = re.compile(r"[0-9@]|" + r"\b(?:" + "|".join(sorted(TITLES, key=len, reverse=True)) + r")\b")


def luhn(digits: str) -> bool:
    total = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits))))
    return total % 10 == 0


def _capital(word: str) -> bool:
    return word[0].isupper() or word[0].lower() == word[0].upper()


def _accepted(kind: str, value: str) -> bool:
    digits = re.sub(r"\D", "", value)
    if kind == "phone":
        return 9 <= len(digits) <= 15 and not re.fullmatch(r"(?:19|20)\d\d[-. ]\d\d[-. ]\d\d.*", value)
    if kind == "person":
        parts = value.split(" ")[1:]
        # A script without letter case has no capitals to ask for.
        return all(_capital(p) for p in parts)
    return True


def entities(text: str) -> Iterator[tuple[int, int, str, str]]:
    """``start, end, kind, value`` of every entity of a text, in order."""
    if not _HINT.search(text):
        return
    at = 0
    while m := _FOUND.search(text, at):
        kind, value = m.lastgroup, m.group()
        if kind == "person" and not _accepted(kind, value):
            title, _, rest = value.partition(" ")
            first = rest.split(" ")[0]
            value = f"{title} {first}" if _capital(first) else ""
        elif kind == "phone":
            value = _phone(text, m)
        elif kind == "card" and not luhn(re.sub(r"\D", "", value)) and _inner(text, m) is not None:
            # A number of no valid card that runs into another entity: what is before it.
            phone = _PHONE.match(text, m.start())
            value = phone and _phone(text, phone) or value
            if value != m.group():
                kind = "ssn" if re.fullmatch(r"\d{3}-\d{2}-\d{4}", value) else "phone"
        if value:
            yield m.start(), m.start() + len(value), kind, value
            at = m.start() + len(value)
        else:  # what the match swallowed behind its first group is searched again
            at = m.start() + len(_GROUP.match(m.group())[0])


_GROUP = re.compile(r"\W*\w+")
_MORE = re.compile(r"(?:[ .-]\d{2,4})*")


_PHONE = re.compile(dict(PATTERNS)["phone"])


def _inner(text: str, m: re.Match) -> int | None:
    """Where in a match of digits the first entity of another kind starts; a card only
    with a valid check digit."""
    for g in re.finditer(r"(?<=[ .-])\d", m.group()):
        other = _FOUND.match(text, m.start() + g.start())
        if other and other.lastgroup != "phone" and (other.lastgroup != "card" or luhn(re.sub(r"\D", "", other.group()))):
            return m.start() + g.start()
    return None


def _phone(text: str, m: re.Match) -> str:
    """The phone at the start of a match, or nothing. It ends before an entity of another
    kind; of a run too long for one phone it is the longest part that leaves none or
    enough digits for another, else the longest that may be one."""
    value, cuts = m.group(), [g.end() for g in re.finditer(r"\d+(?!\d)", m.group())]
    inner = _inner(text, m)
    if inner is not None:
        cuts = [c for c in cuts if m.start() + c <= inner]
    if not cuts:
        return ""
    if cuts[-1] == len(value) and _accepted("phone", value):
        return value
    parts = [value[:c] for c in cuts if _accepted("phone", value[:c])]
    if not parts or cuts[-1] < len(value):
        return parts[-1] if parts else ""
    run = value + _MORE.match(text, m.end())[0]
    left = [len(re.sub(r"\D", "", run[len(x) :])) for x in parts]
    return next((x for x, n in zip(parts[::-1], left[::-1], strict=True) if n == 0 or n >= 9), parts[-1])


def identity(kind: str, value: str) -> str:
    """What makes two mentions the same entity: spelling without separators and case; the
    names of a person as they are."""
    if kind == "email":
        return value.lower()
    return value if kind in ("secret", "ip", "family", "given-m", "given-f") else re.sub(r"[^0-9A-Za-z+]", "", value)


def parts(kind: str, value: str) -> list[tuple[str, str]]:
    """The entities of one mention, ``kind, value``, each with a surrogate of its own. A
    person has a family name and perhaps a given one, so that "Mr Alex Kim" and "Mr Kim"
    keep one family name. A title without gender takes that of a given name in the lists, or
    else one by the name's own characters, the same everywhere."""
    if kind != "person":
        return [(kind, value)]
    title, *names = value.split(" ")
    if len(names) == 1:
        return [("family", names[0])]
    return [(f"given-{_gender(title, names[0])}", names[0]), ("family", names[1])]


def _gender(title: str, given: str) -> str:
    gender = TITLES[title.rstrip(".")]
    if gender != "n":
        return gender
    listed = {g for (g, _), names in GIVEN.items() if given in names}
    return listed.pop() if len(listed) == 1 else "fm"[hashlib.sha256(given.encode()).digest()[0] % 2]


class _Stream:
    """Keyed numbers for one entity and attempt."""

    def __init__(self, key: bytes, *parts: object) -> None:
        self.key, self.message, self.at, self.pool = key, "\x1f".join(map(str, parts)).encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self.pool) < 8:
            self.pool += hmac.new(self.key, self.message + self.at.to_bytes(4, "big"), hashlib.sha256).digest()
            self.at += 1
        out, self.pool = int.from_bytes(self.pool[:8], "big") % n, self.pool[8:]
        return out


def _script(word: str) -> str:
    code = ord(word[0])
    if 0x400 <= code < 0x530:
        return "cyrillic"
    if 0x370 <= code < 0x400 or 0x1F00 <= code < 0x2000:
        return "greek"
    return "latin" if code < 0x250 or 0x1E00 <= code < 0x1F00 else "other"


def _same_letters(word: str, stream: _Stream) -> str:
    """Letters of the same row of the code table, of their case, for scripts without lists."""
    out = []
    for c in word:
        row = [x for x in map(chr, range(ord(c) & ~63, (ord(c) & ~63) + 64)) if x.isalpha() and x.isupper() == c.isupper()]
        out.append(row[stream.below(len(row))] if c.isalpha() else c)
    return "".join(out)


def _name(kind: str, word: str, stream: _Stream, attempt: int) -> str:
    """A family or given name in the script of ``word``. Further attempts add names, so the
    supply grows with the number of names to be told apart."""
    script = _script(word)
    if script == "other":
        return "".join(_same_letters(word, stream) for _ in range(1 + attempt // 8))
    names = FAMILY[script] if kind == "family" else GIVEN[kind[-1], script]
    return "-".join(names[stream.below(len(names))] for _ in range(1 + attempt))


def _same_shape(value: str, stream: _Stream) -> str:
    """Digits by digits, letters by letters of their case, hexadecimal text by such."""
    hexa = re.fullmatch(r"[0-9a-f]+", value) is not None
    out = []
    for c in value:
        if "0" <= c <= "9":
            out.append("0123456789"[stream.below(10)])
        elif "a" <= c <= "z":
            out.append(("abcdef" if hexa else "abcdefghijklmnopqrstuvwxyz")[stream.below(6 if hexa else 26)])
        elif "A" <= c <= "Z":
            out.append("ABCDEFGHIJKLMNOPQRSTUVWXYZ"[stream.below(26)])
        else:
            out.append(c)
    return "".join(out)


def _respelled(value: str, plain: str) -> str:
    """``plain`` (letters and digits) in the separators of ``value``."""
    letters = iter(plain)
    return "".join(next(letters) if c.isascii() and (c.isalnum() or c == "+") else c for c in value)


def surrogate(key: bytes, kind: str, value: str, attempts: dict[tuple[str, str], int] | None = None) -> str:
    """The surrogate of one mention, a function of its entities and their ``attempts`` (0 where
    not given); the mention's own separators and title stay."""
    attempts = attempts or {}
    new = [_surrogate(key, k, v, attempts.get((k, identity(k, v)), 0)) for k, v in parts(kind, value)]
    return " ".join([value.split(" ")[0], *new]) if kind == "person" else new[0]


def _surrogate(key: bytes, kind: str, value: str, attempt: int = 0) -> str:
    same = identity(kind, value)
    stream = _Stream(key, kind, same, attempt)
    if kind == "family" or kind.startswith("given"):
        return _name(kind, value, stream, attempt)
    if kind == "email":
        local, domain = same.split("@")
        out = f"{_same_shape(local, stream)}@{_same_shape(domain.split('.')[0], stream)}.example"
        return out
    if kind == "ip":
        return ".".join(str(1 + stream.below(254)) for _ in range(4))
    if kind == "secret":
        return _same_shape(value, stream)
    if kind == "card":
        body = same[0] + _same_shape(same[1:-1], stream)
        check = next(d for d in "0123456789" if luhn(body + d)) if luhn(same) else str(stream.below(10))
        return _respelled(value, body + check)
    if kind == "iban":
        body = _same_shape(same[4:], stream)
        number = int("".join(str(int(c, 36)) for c in body + same[:2] + "00"))
        return _respelled(value, f"{same[:2]}{98 - number % 97:02d}{body}")
    # The country is read off the number itself, not its spelling.
    keep = 0
    if same.startswith("+"):
        keep = 1 + next((n for n in (1, 2) if same[1 : 1 + n] in CALLING_CODES), 3)
    return _respelled(value, same[:keep] + _same_shape(same[keep:], stream))


def _found(batches: Iterator[pa.RecordBatch], key: bytes) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch):
            rows = set()
            for text in piece.column("text").to_pylist():
                rows.update((k, identity(k, v), v) for _, _, kind, value in entities(text or "") for k, v in parts(kind, value))
            yield _pack([(k, s, v, identity(k, _surrogate(key, k, v))) for k, s, v in sorted(rows)])


def _pack(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["kind", "entity", "value", "image"])


def _again(batches: Iterator[pa.RecordBatch], key: bytes, attempt: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("kind", "entity", "value")), strict=True)
        yield _pack([(k, s, v, identity(k, _surrogate(key, k, v, attempt))) for k, s, v in rows])


def assigned(docs: DataFrame, key: str) -> DataFrame:
    """``kind, entity, attempt`` of the entities whose first surrogate would clash: with
    another entity's, or with an entity of the corpus. All others are on attempt 0."""
    folder = new_folder(docs.sparkSession, "surrogates")
    secret = key.encode()
    schema = "kind string, entity string, value string, image string"
    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(partial(_found, key=secret), schema)
    found = staged(found.groupBy("kind", "entity").agg(F.min("value").alias("value"), F.min_by("image", "value").alias("image")), folder, "found")
    real = found.select("kind", F.col("entity").alias("image"))
    done = found.withColumn("attempt", F.lit(0))
    attempt = 0
    while True:
        first = F.row_number().over(Window.partitionBy("kind", "image").orderBy("attempt", F.xxhash64("entity"), "entity"))
        ranked = done.withColumn("r", first)
        taken = real.withColumn("_real", F.lit(True))
        ranked = ranked.join(taken, ["kind", "image"], "left")
        clash = staged(ranked.where("r > 1 or _real").select("kind", "entity", "value"), folder, f"clash{attempt}")
        if clash.isEmpty():
            return done.where("attempt > 0").select("kind", "entity", "attempt")
        attempt += 1
        moved = clash.mapInArrow(partial(_again, key=secret, attempt=attempt), schema).withColumn("attempt", F.lit(attempt))
        done = staged(done.join(clash.select("kind", "entity"), ["kind", "entity"], "left_anti").unionByName(moved), folder, f"done{attempt}")


def _mentioned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch):
            rows = [
                (digest, kind, same)
                for digest, text in zip(piece.column("digest").to_pylist(), piece.column("text").to_pylist(), strict=True)
                for kind, same in sorted({(k, identity(k, v)) for _, _, kind, value in entities(text or "") for k, v in parts(kind, value)})
            ]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.string()), strict=True)], names=["digest", "kind", "entity"]
            )


def _replaced(batches: Iterator[pa.RecordBatch], key: bytes) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch):
            counts, texts = [], []
            for text, later in zip(piece.column("text").to_pylist(), piece.column("later").to_pylist(), strict=True):
                attempts = {(x["kind"], x["entity"]): x["attempt"] for x in later or []}
                out, at, n = [], 0, 0
                for start, end, kind, value in entities(text or ""):
                    out += [text[at:start], surrogate(key, kind, value, attempts)]
                    at, n = end, n + 1
                counts.append(n)
                texts.append(text if not n else "".join([*out, text[at:]]))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(counts, pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "n_entities", "text"]
            )


def replaced(docs: DataFrame, key: str) -> DataFrame:
    """``doc_id, n_entities, text`` for every row of ``docs``: its text with every entity
    replaced. A null text stays null and has none; repeated rows get equal results."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    folder = new_folder(docs.sparkSession, "surrogates")
    later = staged(assigned(docs, key), folder, "later")
    # Overrides reach a text by a hash of it, so that equal texts and null ids need no care.
    digest = F.xxhash64("text")
    hits = rows.select(digest.alias("digest"), "text").mapInArrow(_mentioned, "digest bigint, kind string, entity string").distinct()
    hits = hits.join(later, ["kind", "entity"]).groupBy("digest").agg(F.collect_list(F.struct("kind", "entity", "attempt")).alias("later"))
    rows = rows.withColumn("digest", digest).join(broadcast_if_small(staged(hits, folder, "hits")), "digest", "left")
    return rows.select("doc_id", "text", "later").mapInArrow(
        partial(_replaced, key=key.encode()), "doc_id bigint, n_entities bigint, text string"
    )
