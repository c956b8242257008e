"""Personal data replaced by keyed surrogates of the same kind.

Every entity is a word of a domain given by its kind and format: which characters stand where.
A keyed permutation without fixed points maps the domain onto itself. So an entity always gets
the same surrogate, in every document and without any table (coreference), two entities of a
format never get the same one (distinctness), and the surrogate differs from the entity. Where
a domain has rules (check digits, names in use), the permutation is walked until the rule
holds, which keeps it one to one. ``collisions`` checks that over a corpus.

A name is found after a title; its further mentions in the same text, in full or by the last
word, get the same surrogate.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portfolio_ops.llm.text import chunks, id_and_text
from portfolio_ops.session import stage, unstage

# fixed values: given names by gender and script, titles by gender
GIVEN = {
    ("female", "latin"): ["Alice", "Anna", "Beatriz", "Carla", "Charlotte", "Claire", "Elena",
                          "Emily", "Emma", "Greta", "Hannah", "Ingrid", "Isabel", "Julia", "Laura",
                          "Lucia", "Margaret", "Maria", "Marie", "Mary", "Nora", "Olivia", "Paula",
                          "Sarah", "Sophie", "Susan", "Teresa", "Ursula"],
    ("male", "latin"): ["Albert", "Andrew", "Antonio", "Bruno", "Carlos", "Charles", "Daniel",
                        "David", "Erik", "Felix", "George", "Hans", "Henry", "Jack", "James", "John",
                        "Juan", "Karl", "Louis", "Luis", "Martin", "Michael", "Oscar", "Paul",
                        "Peter", "Pierre", "Robert", "Thomas"],
    ("female", "cyrillic"): ["Анна", "Дарья", "Елена", "Ирина", "Мария", "Наталья", "Ольга", "Татьяна"],
    ("male", "cyrillic"): ["Алексей", "Андрей", "Дмитрий", "Иван", "Михаил", "Николай", "Пётр", "Сергей"],
    ("female", "greek"): ["Άννα", "Ελένη", "Μαρία", "Σοφία"],
    ("male", "greek"): ["Γιώργος", "Δημήτρης", "Κώστας", "Νίκος"],
}
TITLES = ["Mr", "Mrs", "Ms", "Miss", "Mx", "Sir", "Madam", "Dr", "Prof", "Herr", "Frau", "Monsieur",
          "Madame", "Mme", "Mlle", "Señor", "Señora", "Señorita", "Sr", "Sra", "Don", "Doña",
          "Господин", "Госпожа", "Κύριος", "Κυρία"]
ACADEMIC = ["Dr", "Prof"]   # may follow another title
# fixed values: words that open a sentence after 'Sir.' or 'Miss'; not carried on as names
OPENERS = frozenset((
    "The This That These Those There Then You Your We Our He His She It Its They Their And But Or If In On At "
    "To For From With What When Where Who Why How Yes No Not As Is Are Was Were Have Has "
    "Der Die Das Und Ich Sie Er Es Wir Les Et Je Vous Il Elle Nous El Los Las").split() + TITLES)
# fixed values: letters of a script that may stand for each other
LETTERS = ["0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "AEIOU", "BCDFGHJKLMNPQRSTVWXYZ",
           "áéíóú", "àèìòù", "âêîôû", "äëïöü", "ãñõ", "çß", "ÁÉÍÓÚ", "ÄËÏÖÜ", "ÇÑ",
           "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "АЕЁИОУЭЮЯ", "БВГДЖЗКЛМНПРСТФХЦЧШЩ",
           "αεηιουω", "βγδζθκλμνξπρστφχψ", "άέήίόύώ", "ΑΕΗΙΟΥΩ", "ΒΓΔΖΘΚΛΜΝΞΠΡΣΤΦΧΨ", "ΆΈΉΊΌΎΏ"]
PLAIN = ["0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]
HEX = ["0123456789abcdef", "ABCDEF"]
# fixed values: country codes of one and two digits; all others have three
COUNTRY_CODES = frozenset(
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 "
    "66 81 82 84 86 90 91 92 93 94 95 98".split())
CACHED_CHARS = 256      # longer entities are replaced without the cache

OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
NUMBERS = re.compile(
    rf"(?P<ip>(?<![\w.]){OCTET}(?:\.{OCTET}){{3}}(?!\w|\.\d))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<card>(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-]))"
    r"|(?P<phone>(?<!\w)(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,4}"
    r"|\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}"
    r"|\d{3}[ .-]\d{3}[ .-]\d{4})(?!\w))", re.ASCII)
SECRETS = re.compile(
    r"(?<![A-Za-z0-9_])(?:(?P<hex>(?=[a-f]*\d)[0-9a-f]{32,}|(?=[A-F]*\d)[0-9A-F]{32,})"
    r"|(?P<key>AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,}))(?![A-Za-z0-9_])")
ASSIGNED = re.compile(
    r"(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)[\"']?\s{0,3}[=:]\s{0,3}[\"']?"
    r"(?P<secret>(?=[A-Za-z_./+-]*\d)[A-Za-z0-9_./+-]{8,})", re.IGNORECASE | re.ASCII)
HAS_DIGIT = re.compile(r"\d", re.ASCII)
IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)", re.ASCII)
DOMAIN = re.compile(r"@(?:[^\W_](?:[^\W_]|-)*+(?<!-)\.)++[^\W\d_]{2,}")
# letters, digits, hyphens and apostrophes, and the marks that letters of some scripts carry
IN_NAME = r"[\w'’\u0300-\u036F\u0591-\u05C7\u064B-\u065F\u0900-\u0E7F-]"
NAMES = re.compile(r"(?<!\w)(?:" + "|".join(TITLES) + r")\.? (?:(?:" + "|".join(ACADEMIC)
                   + rf")\.? )*+(?P<name>[^\W\d_]{IN_NAME}+(?: [^\W\d_a-zа-яα-ω]{IN_NAME}+){{0,2}})")
RUN = re.compile(r"\w+")
MAYBE_NAME = re.compile(r"(?:" + "|".join(TITLES) + r")\.? ")


class Surrogates:
    """Surrogates under one secret key."""

    def __init__(self, key: str):
        self._secret = hashlib.sha256(key.encode()).digest()
        self.known = {name: list_ for list_ in GIVEN.values() for name in list_}
        self.find = lru_cache(maxsize=100_000)(self._find)

    # --- permutations -------------------------------------------------------------------

    def _mixed(self, value: int, size: int, kind: str, back: bool) -> int:
        """Feistel network over the numbers below ``size``; walked until inside."""
        half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
        mask, length = (1 << half) - 1, (half + 7) // 8
        rounds = range(7, -1, -1) if back else range(8)
        while True:
            left, right = value >> half, value & mask
            for r in rounds:
                side = left if back else right
                seed = self._secret + kind.encode() + bytes([r]) + side.to_bytes(length, "big")
                f = int.from_bytes(hashlib.shake_128(seed).digest(length), "big") & mask
                left, right = (right ^ f, left) if back else (right, left ^ f)
            value = (left << half) | right
            if value < size:
                return value

    def permute(self, value: int, size: int, kind: str) -> int:
        """One to one over ``range(size)`` and never the value itself (``size`` over 1): a keyed
        step of one in the order that the network gives."""
        if size < 2:
            return value
        place = (self._mixed(value, size, kind, False) + 1) % size
        return self._mixed(place, size, kind, True)

    def word(self, text: str, alphabets: list[str], kind: str) -> str:
        """A word of the same format: every character stays in its alphabet, a letter of no
        alphabet in its script and category; others stay."""
        own = [next((a for a in alphabets if c in a), None) or script_alphabet(c, alphabets is LETTERS)
               for c in text]
        levels = _levels([(a.index(c), len(a)) for c, a in zip(text, own) if a])
        value, size = levels[-1][0]
        shape = "".join("-" if a is None else a[0] for a in own)
        places = iter(_digits(self.permute(value, size, f"{kind}:{shape}"), levels))
        return "".join(a[next(places)] if a else c for c, a in zip(text, own))

    # --- kinds --------------------------------------------------------------------------

    def email(self, text: str) -> str:
        """Case of an address does not matter: the lower-case address decides."""
        head, _, top = text.rpartition(".")
        return _like(self.word("".join(map(_lower, head)), PLAIN, "email"), head) + "." + top

    def ip(self, text: str) -> str:
        value = int.from_bytes(bytes(map(int, text.split("."))), "big")
        return ".".join(map(str, self.permute(value, 1 << 32, "ip").to_bytes(4, "big")))

    def card(self, text: str) -> str:
        """The check digit is as right or wrong as before."""
        digits = re.sub(r"\D", "", text)
        body = self.word(digits[:-1], PLAIN, "card")
        off = int(digits[-1]) - _luhn(digits[:-1])
        return _fill(text, body + str((_luhn(body) + off) % 10))

    def ssn(self, text: str) -> str:
        digits, valid = text.replace("-", ""), _ssn(text)
        while True:
            digits = self.word(digits, PLAIN, "ssn")
            out = _fill(text, digits)
            if _ssn(out) == valid:
                return out

    def phone(self, text: str) -> str:
        """The country code stays; the same number in another style gets the same digits."""
        digits = re.sub(r"\D", "", text)
        code = ""
        if text.startswith("+"):
            code = next((digits[:n] for n in (1, 2) if digits[:n] in COUNTRY_CODES), digits[:3])
        rest = digits[len(code):]
        return _fill(text, code + self.word(rest, PLAIN, "phone"))

    def iban(self, text: str) -> str:
        compact = text.replace(" ", "")
        body = self.word(compact[4:], PLAIN, "iban")
        check = 98 - _mod97(body + compact[:2] + "00")
        return _fill(text, f"{compact[:2]}{check:02d}{body}")

    def hex(self, text: str) -> str:
        alphabets = HEX if text == text.lower() else ["0123456789ABCDEF"]
        while True:
            text = self.word(text, alphabets, "hex")
            if any(c.isdigit() for c in text):
                return text

    def key(self, text: str) -> str:
        head = re.match(r"AKIA|gh[pousr]_|sk-", text).group()
        return head + self.word(text[len(head):], PLAIN, "key")

    def secret(self, text: str) -> str:
        return self.word(text, PLAIN, "secret")

    def name(self, text: str) -> str:
        return re.sub(r"[^\W\d_]+", lambda m: self._name(m.group()), text)

    def _name(self, part: str) -> str:
        """A listed given name becomes another of its gender and script. Another name becomes
        one of the same script, shape and last letter that is not a listed name."""
        names = self.known.get(part)
        if names:
            return names[self.permute(names.index(part), len(names), "given:" + names[0])]
        changed = part
        while True:
            changed = self.word(changed[:-1], LETTERS, "name:" + part[-1]) + part[-1]
            if changed == part:     # nothing but the last letter can change
                return self.word(part, LETTERS, "name")
            if changed not in self.known:
                return changed

    def _find(self, kind: str, text: str) -> str:
        return getattr(self, kind)(text)

    def surrogate(self, kind: str, text: str) -> str:
        return (self.find if len(text) <= CACHED_CHARS else self._find)(kind, text)

    # --- texts --------------------------------------------------------------------------

    def entities(self, text: str) -> list[tuple[int, int, str]]:
        """Start, end and kind of the entities, whole and none inside another: the first to start
        wins, of those the longest, then the order of the kinds below."""
        found = []
        if "@" in text:
            for m in DOMAIN.finditer(text):
                start = m.start()
                while start and (text[start - 1].isalnum() or text[start - 1] in "_.%+-"):
                    start -= 1
                while start < m.start() and text[start] in ".-+%":
                    start += 1
                if start < m.start():
                    found.append((start, m.end(), "email"))
        numbered = HAS_DIGIT.search(text) is not None
        for m in SECRETS.finditer(text) if numbered else ():
            found.append((m.start(), m.end(), m.lastgroup))
        for m in ASSIGNED.finditer(text) if numbered and ("=" in text or ":" in text) else ():
            found.append((m.start("secret"), m.end("secret"), "secret"))
        for m in IBAN.finditer(text) if numbered else ():
            compact = m.group().replace(" ", "")
            if _mod97(compact[4:] + compact[:4]) == 1:
                found.append((m.start(), m.end(), "iban"))
        for m in NUMBERS.finditer(text) if numbered else ():
            if m.lastgroup != "phone" or 7 <= sum(map(str.isdigit, m.group())) <= 15:
                found.append((m.start(), m.end(), m.lastgroup))
        if MAYBE_NAME.search(text):
            named = [m.span("name") for m in NAMES.finditer(text)]
            found += [(a, b, "name") for a, b in [*named, *_mentions(text, {text[a:b] for a, b in named})]]
        found.sort(key=lambda e: (e[0], -e[1]))     # stable: kinds in the order above
        out, end = [], 0
        for e in found:
            if e[0] >= end:
                out.append(e)
                end = e[1]
        return out

    def replace(self, text: str) -> tuple[str, list[tuple[str, str, str]]]:
        """The text with surrogates, and (kind, entity, surrogate) of each."""
        parts, done, pairs = [], 0, []
        for start, end, kind in self.entities(text):
            surrogate = self.surrogate(kind, text[start:end])
            parts += [text[done:start], surrogate]
            pairs.append((kind, text[start:end], surrogate))
            done = end
        return ("".join([*parts, text[done:]]), pairs) if pairs else (text, pairs)


def _mentions(text: str, names: set[str]) -> list[tuple[int, int]]:
    """Spans of the whole-word occurrences of ``names`` and of their last words, longest first.

    A single word is left out when it starts in lower case ('Mr and Mrs') or is one of
    ``OPENERS``. Cost is that of the text, however many names there are.
    """
    wanted = set()
    for name in names:
        words = re.sub(r"['’]s?(?!\w)|-+(?!\w)", "", name).split()
        wanted.add(" ".join(words))
        wanted.add(words[-1])
    wanted = {w for w in wanted if " " in w or not (w[0].islower() or w in OPENERS)}
    sizes: dict[str, set[int]] = {}     # first run of a name: numbers of runs
    for w in wanted:
        runs = RUN.findall(w)
        sizes.setdefault(runs[0], set()).add(len(runs))
    more = {n: re.compile(r"\w++(?:\W++\w++){%d}" % (n - 1)) for own in sizes.values() for n in own}
    out = []
    for m in RUN.finditer(text) if sizes else ():
        for n in sorted(sizes.get(m.group(), ()), reverse=True):
            whole = more[n].match(text, m.start())
            if whole and " ".join(whole.group().split()) in wanted:
                out.append(whole.span())
                break
    return out


def _levels(pairs: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """(value, size) of the places of a number, then of ever larger groups of places, last of the
    whole number; pairwise, so that a long word costs no square of its length."""
    levels = [pairs or [(0, 1)]]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([(low[k][0] * low[k + 1][1] + low[k + 1][0], low[k][1] * low[k + 1][1])
                       if k + 1 < len(low) else low[k] for k in range(0, len(low), 2)])
    return levels


def _digits(value: int, levels: list[list[tuple[int, int]]]) -> list[int]:
    """The places of ``value`` in the sizes of ``levels``."""
    values = [value]
    for low in reversed(levels[:-1]):
        values = [v for k, both in enumerate(values)
                  for v in (divmod(both, low[2 * k + 1][1]) if 2 * k + 1 < len(low) else (both,))]
    return values


@lru_cache(maxsize=2)
def _script_alphabets(names: bool) -> dict[str, str]:
    """The letters of the basic plane beyond ASCII by script and category, for names without
    those of ``LETTERS``."""
    listed = set("".join(LETTERS)) if names else set()
    groups: dict[tuple[str, str], list[str]] = {}
    for c in map(chr, range(0x80, 0x10000)):
        if c.isalpha() and c not in listed:
            groups.setdefault((unicodedata.name(c, "?").split()[0], unicodedata.category(c)), []).append(c)
    few = "".join(c for g in groups.values() if len(g) < 8 for c in g)
    alphabets = ["".join(g) if len(g) >= 8 else few for g in groups.values()]
    return {c: alphabet for alphabet, g in zip(alphabets, groups.values()) for c in g}


def script_alphabet(c: str, names: bool) -> str | None:
    """Letters that may stand for ``c``: those of its script and category, of a few letters all
    such together, beyond the basic plane those of its category in the 256 code points around it."""
    if c.isascii() or not c.isalpha():
        return None
    if ord(c) >= 0x10000:
        start, kind = ord(c) & ~0xFF, unicodedata.category(c)
        return "".join(x for x in map(chr, range(start, start + 256)) if unicodedata.category(x) == kind)
    return _script_alphabets(names).get(c)


def _lower(c: str) -> str:
    return c.lower() if len(c.lower()) == 1 else c


def _like(word: str, model: str) -> str:
    return "".join(c.upper() if m.isupper() and len(c.upper()) == 1 else c for c, m in zip(word, model))


def _fill(model: str, content: str) -> str:
    """``model`` with its letters and digits replaced in order."""
    rest = iter(content)
    return "".join(next(rest) if c.isalnum() else c for c in model)


def _luhn(body: str) -> int:
    doubled = [int(c) * (2 - k % 2) for k, c in enumerate(reversed(body))]
    return -sum(d - 9 if d > 9 else d for d in doubled) % 10


def _ssn(text: str) -> bool:
    area, group, serial = text.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


@lru_cache(maxsize=4)
def surrogates(key: str) -> Surrogates:
    return Surrogates(key)


def scrub(docs: DataFrame, key: str) -> DataFrame:
    """``doc_id, n_entities, n_distinct, kinds, text``: every whole text with surrogates.

    ``kinds`` is the sorted list of kinds found. Null text is empty. A null or repeated
    ``doc_id`` is passed through, one row per input row; other columns are ignored. No row
    depends on another, so there is no shuffle and no table of entities.
    """
    def run(batches):
        own = surrogates(key)
        for ids, texts in chunks(batches):
            rows = [own.replace(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([len(p) for _, p in rows], pa.int64()),
                 pa.array([len(set(p)) for _, p in rows], pa.int64()),
                 pa.array([sorted({k for k, _, _ in p}) for _, p in rows], pa.list_(pa.string())),
                 pa.array([t for t, _ in rows], pa.string())],
                names=["doc_id", "n_entities", "n_distinct", "kinds", "text"])
    return id_and_text(docs).mapInArrow(
        run, "doc_id long, n_entities long, n_distinct long, kinds array<string>, text string")


def scrub_rows(docs: DataFrame, key: str) -> DataFrame:
    """The rows of ``docs`` with surrogates in ``text``; null text stays null."""
    column = docs.columns.index("text")

    def run(batches):
        own = surrogates(key)
        for batch in batches:
            texts = pa.array([t if t is None else own.replace(t)[0]
                              for t in batch.column(column).to_pylist()], pa.string())
            yield batch.set_column(column, batch.schema.field(column).with_type(pa.string()), texts)
    return docs.mapInArrow(run, docs.schema)


class SurrogateCollision(ValueError):
    """Two entities of a corpus have one surrogate, or one entity has two."""


def checked(docs: DataFrame, key: str) -> DataFrame:
    """``docs``, once the surrogates of all its entities are known to be distinct and stable.

    The entities of the whole corpus are staged, then grouped by Spark; only whether a collision
    exists reaches the driver. A collision raises ``SurrogateCollision``: choose another key.
    """
    found = stage(entity_table(docs, key), "entities")
    collide = not collisions(found).isEmpty()
    unstage(found)
    if collide:
        raise SurrogateCollision("surrogates collide under this key")
    return docs


def entity_table(docs: DataFrame, key: str) -> DataFrame:
    """Distinct ``kind, entity, surrogate`` of a corpus. ``entity`` is a keyed digest of the
    canonical entity, so that the table holds no personal data."""
    def run(batches):
        own = surrogates(key)
        for _, texts in chunks(batches):
            found = {p for t in texts for p in own.replace(t)[1]}
            rows = [(k, hashlib.blake2b(e.encode(), key=own._secret, digest_size=16).hexdigest(), s)
                    for k, e, s in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], pa.string()) for i in range(3)],
                names=["kind", "entity", "surrogate"])
    return id_and_text(docs).mapInArrow(run, "kind string, entity string, surrogate string").distinct()


def collisions(entities: DataFrame) -> DataFrame:
    """Surrogates that stand for two entities, or entities with two surrogates; none expected."""
    twice = entities.groupBy("surrogate").agg(F.min("entity").alias("one"), F.max("entity").alias("two")) \
        .where("one != two").select("surrogate")
    split = entities.groupBy("kind", "entity").agg(
        F.min("surrogate").alias("surrogate"), F.max("surrogate").alias("two")) \
        .where("surrogate != two").select("surrogate")
    return twice.union(split)
