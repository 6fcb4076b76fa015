"""Line-oriented reading of quotation texts: document fields, item tables, totals.

A ``Reader`` goes over a document's lines, since its rules look back and ahead; ``parse_documents`` runs it in Arrow batches, one document
at a time, and turns a document's failure into a row of its own.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Collection, Iterator
from dataclasses import dataclass, field
from itertools import compress, count
from operator import attrgetter
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.units import UNIT_WORDS, any_of

#: Labels that announce a document's fields, in the order in which they are tried.  Labels with a seller's own name are handed in.
CUSTOMER_LABELS = ["customer", "customer name", "client", "client name", "bill to", "ship to", "buyer", "to"]
SUBJECT_LABELS = ["subject", "sub", "re", "regarding"]
NUMBER_LABELS = [
    "quotation no", "quotation no.", "quotation number", "quote no", "quote no.", "quote number", "quotation ref", "quotation reference", "proposal no", "proposal no.", "proposal number",
    "offer no", "offer no.", "reference no", "ref no", "our quotation no", "our quotation no.", "our quotation number", "our quote no", "our quote no.", "ref",
]
#: Names of table columns.
HEADER_NAMES = {
    "item_no": ["sr no", "sr. no", "s.no", "s. no", "sl no", "sl. no", "sl.no", "no", "no.", "item no", "item no.", "item number", "item"],
    "description": ["description", "item description", "material description", "product description", "equipment description", "particulars", "details", "scope of supply", "material", "product"],
    "quantity": ["qty", "qty.", "quantity", "quantity nos", "qnty"],
    "unit": ["unit", "uom", "units"],
    "unit_price": ["unit price", "unit rate", "rate", "price", "rate/unit", "rate per unit", "basic rate", "unit cost"],
    "total_price": ["total price", "total amount", "amount", "amount (rs)", "amount(rs)", "amount (inr)", "total", "line total", "extended amount", "value"],
}
#: What ends an item table.
STOP_MARKS = ["scope definition", "scope defin", "commercial conditions", "terms and conditions", "scope of supply", "technical specifications", "warranty", "payment terms", "delivery terms"]
SUBTOTALS = ["subtotal", "sub total", "sub-total", "total before tax"]
TAXES = ["gst", "igst", "cgst", "sgst", "tax", "vat", "sales tax"]
DISCOUNTS = ["discount", "less discount", "discount amount"]
GRAND_TOTALS = ["grand total", "net total", "total amount", "final total", "total payable", "net amount", "amount payable"]
#: Texts that stand for a price.
PRICE_WORDS = ["quoted", "included", "inclusive", "not quoted", "existing", "tbd", "na", "n/a", "ls", "as per actual", "not used in a system"]
ITEM_FIELDS = ["product", "make", "model", "version"]
UNIT_WORD = re.compile(any_of(UNIT_WORDS) + r"\.?", re.I)
QUANTITY = re.compile(rf"(\d+(?:\.\d+)?)\s*({UNIT_WORD.pattern})", re.I)
ITEM_NUMBER = re.compile(r"\d+(?:\.\d+)*[.)]?")
NOT_NORMAL = re.compile(r"[^a-z0-9\s./()-]")


#: NOT_NORMAL and all blanks for ASCII, which a table replaces faster.
BLANKED = bytes(32 if i < 128 and re.match(r"[^a-z0-9./()-]", chr(i)) else i for i in range(256))


def normal(line: str) -> str:
    lower = line.lower()
    if "&" in lower:
        lower = lower.replace("&", "and")
    if lower.isascii():
        return b" ".join(lower.encode().translate(BLANKED).split()).decode()
    return " ".join(NOT_NORMAL.sub(" ", lower).split())


def number_in(text: str) -> float | None:
    """The permissive reading: everything but digits, comma, point and minus is dropped first."""
    kept = re.sub(r"[^0-9,.\-]", "", re.sub(r"/-\s*$", "", text.strip())).replace(",", "")
    return float(kept) if re.fullmatch(r"-?(?:\d+\.?\d*|\.\d+)", kept) else None


STRICT_NUMBER = re.compile(r"\s*(?:₹|Rs\.?|INR|USD|\$|SAR|€|£)?\s*(\d{1,3}(?:,\d{1,3})+|\d+)(\.\d{1,2})?\s*(?:/[-=])?\s*", re.I)


@functools.lru_cache(50_000)
def strict_number(text: str) -> float | None:
    """Money as a whole cell, or nothing."""
    m = STRICT_NUMBER.fullmatch(text)
    return float(m[1].replace(",", "") + (m[2] or "")) if m else None


def _has(text: str, words: list[str]) -> bool:
    for w in words:  # noqa: SIM110  a generator costs more than the look
        if w in text:
            return True
    return False


def _marks(*names: str) -> list[str]:
    """A word of every name of these columns: a text without them holds none of the names, on however many lines."""
    words = {max(name.split(), key=len) for f in names for name in HEADER_NAMES[f]}
    return sorted(w for w in words if not any(x != w and x in w for x in words))


DESCRIPTION_MARKS, PRICE_MARKS = _marks("description"), _marks("unit_price", "total_price")
TOTALS = {"subtotal": SUBTOTALS, "tax": TAXES, "discount": DISCOUNTS, "grand_total": GRAND_TOTALS}
NO_TOTALS = dict.fromkeys(TOTALS)
TOTAL_LABELS = tuple(x for labels in TOTALS.values() for x in labels)
ENDS = tuple(GRAND_TOTALS + SUBTOTALS)
ATTENTION = re.compile(r"kind\s*attention\b|attention\b|attn\b|(?:mr|mrs|ms|miss|dr|shri|smt)\.?\s+\S")
FIRST_NUMBER = re.compile(r"[-+]?\d[\d,]*(?:\.\d+)?")
BLANKS = re.compile(r"\s+")
DATED = re.compile(r"(?i)dated.*$")
BARE_NUMBER = re.compile(r"\d+(?:\.\d+)?")
FIELD_LABEL = re.compile(rf"\b({'|'.join(ITEM_FIELDS)})\b\s*[:\-]", re.I)
DATES = [re.compile(p) for p in (r"\d{1,2}[./-]\d{1,2}[./-]\d{2,4}", r"\d{4}[./-]\d{1,2}[./-]\d{1,2}", r"\d{1,2}\s+[A-Za-z]+\s+\d{2,4}")]
MESSRS = re.compile(r"(?i)m/s\.?\s*.+")
#: The shape of a line has each digit as 0.  No rule for lines asks which digit stands somewhere, so all lines of a shape have their facts at the same places.
SHAPE = bytes.maketrans(b"123456789", b"000000000")
#: Shapes and lines whose facts a reader keeps; it starts anew beyond that.
KNOWN = 50_000
#: A value that is no part of its line as it stands, as it has other blanks; it is read from each line.
AGAIN = None
NOWHERE = slice(0, 0)


@dataclass(slots=True)
class Line:
    """What a line of some shape says by itself, as places in the line.

    ``labels``: None, or for each list of labels None or the places of the value behind the first label and of one behind another.  ``total``: its name and place.
    """

    labels: list[tuple[slice | None, slice | None] | None] | None
    total: tuple[str, slice | None] | None
    date: slice | None
    description: bool
    price: bool
    stop: bool
    end: bool


#: Of lines that say nothing, and of numbers with commas among them.
PLAIN, NUMERIC = None, False


class Known(dict):
    """What lines say; ``learn`` finds it out for a line that is not known yet."""

    def __init__(self, learn: Callable):
        self.learn = learn

    def __missing__(self, x: str):
        return self.learn(x)


class Cell:
    """What a line of a table says by itself; the defaults are those of a number with commas.

    ``alike``: lines of one number have the same part in any item, whatever else they say; None if an item with this line must be read whole.
    ``fields``: the labelled fields, if the line holds nothing else.
    """

    start = unit = note = drop = fielded = bare = False
    quantity: tuple[float, str] | None = None
    fields: dict[str, str] | None = None
    money: float | None = None
    price, digits = True, True
    alike: int | None = 0


NUMBER = Cell()


class Plan(NamedTuple):
    """Which lines of an item say what; numbers of lines in its block."""

    words: list[int]
    fields: list[int]
    quantity: int | None
    unit: int | None
    unit_price: int | None
    total_price: int | None
    confidence: str
    warning: str


@functools.lru_cache(4096)
def header_names(window: tuple[str, ...]) -> dict[str, str] | None:
    """The columns, with the name of each, of the first of these lines or as many more as name a description and a price."""
    parts = [normal(x) for x in window]
    for width in range(1, len(parts) + 1):
        text = " ".join(filter(None, parts[:width]))
        found = {f: name for f, names in HEADER_NAMES.items() if (name := next((x for x in names if x in text), None))}
        if "description" in found and ("unit_price" in found or "total_price" in found):
            return found
    return None


def note_lines(region: list[str]) -> set[int]:
    """Numbers of the lines of notes and of their 1., 2., ... lists, in order."""
    out, expected = set(), 0
    for i, line in enumerate(region):
        if expected and re.match(rf"{expected}[.)](\s|$)", line):
            out.add(i)
            expected += 1
            continue
        expected = 0
        if normal(line) in ("note", "notes"):
            following = next((x for x in region[i + 1 : i + 4] if x.strip()), "")
            if re.match(r"1[.)](\s|$)", following):
                out.add(i)
                expected = 1
    return out


@dataclass(slots=True)
class Item:
    item_no: str
    description: str = ""
    fields: dict[str, str] = field(default_factory=dict)
    quantity: float | None = None
    unit: str = ""
    unit_price_raw: str = ""
    unit_price: float | None = None
    total_price_raw: str = ""
    total_price: float | None = None
    raw: str = ""
    confidence: str = "LOW"
    warning: str = ""


def labelled_fields(lines: list[str]) -> tuple[dict[str, str], list[str]]:
    """Values of ``Make:`` and the like, several on a line or on the line below, and the lines left."""
    found, left, i = {}, [], 0
    while i < len(lines):
        hits = list(FIELD_LABEL.finditer(lines[i]))
        if not hits:
            left.append(lines[i])
            i += 1
            continue
        if lines[i][: hits[0].start()].strip():
            left.append(lines[i][: hits[0].start()].strip())
        for h, nxt in zip(hits, [*hits[1:], None], strict=True):
            value = lines[i][h.end() : nxt.start() if nxt else None].strip(" ,;:-|")
            if not value and nxt is None and i + 1 < len(lines):
                i += 1
                value = lines[i].strip(" ,;:-|")
            found.setdefault(h[1].lower(), value)
        i += 1
    return found, left


FIELDS = ["customer", "customer_confidence", "subject", "quotation_number", "quotation_date", "subtotal", "tax", "discount", "grand_total", "boq_detected", "boq_headers", "document_confidence", "warnings", "items"]


class Reader:
    """Reads documents; what a line says by itself is found once for each shape of lines, and most lines of offers are of few shapes."""

    def __init__(self, strict: bool = False, number_labels: list[str] = NUMBER_LABELS, only: Collection[str] = FIELDS):
        """``only``: the fields that are wanted of documents."""
        self.only = set(only)
        self.judged = "document_confidence" in self.only
        self.wanted = bool(self.only & {"items", "warnings"})
        self.dated = "quotation_date" in self.only
        self.asked = [k for k, names in enumerate(({"customer", "customer_confidence"}, {"subject"}, {"quotation_number"})) if self.judged or self.only & names]
        self.money = strict_number if strict else number_in
        self.strict = strict
        self.lists = [CUSTOMER_LABELS, SUBJECT_LABELS, number_labels]
        self.names = [{normal(x) for x in labels} for labels in self.lists]
        every = list(dict.fromkeys(x for labels in self.lists for x in labels))
        self.odd = any(x != normal(x) or not re.search("[a-z]", x) or len(x) < 2 for x in every)  # then no line can be passed over by its normal form
        marked = [[(x, (x + " ", x + ":", x + ".")) for x in labels] for labels in self.lists]
        self.near = [{"": labels} | {x[:2]: [y for y in labels if y[0][:2] == x[:2]] for x, _ in labels} for labels in marked]
        self.heads = [tuple(labels) for labels in self.lists]
        self.head = tuple(every)
        self.opens = [re.compile(f"(?:{'|'.join(map(re.escape, labels))})(?:[ :.]|$)") for labels in self.lists]
        self.behind = {x: re.compile(rf"(?i)^\W*{r'[\s.]*'.join(re.escape(w) for w in x.split())}\b\s*[.:\-|]*\s*") for x in every}
        self.colon = {x: re.compile(rf"{re.escape(x)}\s*:") for x in every}
        self.shape = SHAPE if not re.search(r"\d", "".join(every)) else None
        self.lines = Known(lambda x: self.line(x))
        self.skips = [Known(lambda x, k=k: self.skip(x, k)) for k in range(3)]
        self.cells = Known(lambda x: self.cell(x))
        self.kinds: dict[tuple, int] = {}
        self.plans: dict[tuple, Plan | None] = {}
        self.unused = count(1)  # never reset: a number keeps its meaning when what is known is dropped

    def skippable(self, line: str, k: int) -> bool:
        n = normal(line)
        return not n or n == "name" or n in self.names[k] or bool(ATTENTION.match(n))

    def skip(self, shape: str, k: int) -> bool:
        """Whether lines of a shape that is not known yet are skippable."""
        if len(self.skips[k]) >= KNOWN:
            self.skips[k].clear()
        self.skips[k][shape] = out = self.skippable(shape, k)
        return out

    def label_places(self, line: str, n: str, k: int) -> tuple[slice | None, slice | None] | None:
        """The places of ``label_values`` in the line; AGAIN for a value that is no part of it."""
        found = self.label_values(line, n, k)
        return found and tuple(NOWHERE if not value else slice(at, at + len(value)) if line[at : at + len(value)] == value else AGAIN for value, at in found)

    def label_values(self, line: str, n: str, k: int) -> list[tuple[str, int]] | None:
        """Usable values behind the first label of list ``k`` that opens the line, and behind the first of the others that has one; where each begins if it has no other blanks."""
        lower, values = line.lower(), []
        for label, marks in self.near[k].get("" if self.odd else n[:2], ()):
            if n != label and not n.startswith(marks) and not (lower.startswith(label) and self.colon[label].match(lower)):
                continue
            behind = self.behind[label].match(line) if n != label else None
            rest = line[behind.end() if behind else 0 :] if n != label else ""
            value = BLANKS.sub(" ", rest).strip(" :-|")
            at = len(line) - len(rest.lstrip(" :-|"))
            values.append((value if value and not self.skippable(value, k) else "", at))
        return [values[0], next((v for v in values[1:] if v[0]), ("", 0))] if values else None

    def line(self, x: str) -> Line | bool | None:
        """Facts of lines of a shape that is not known yet; PLAIN or NUMERIC if there are none."""
        if len(self.lines) >= KNOWN:
            self.lines.clear()
        self.lines[x] = out = self.read(x)
        return out

    def read(self, x: str) -> Line | bool | None:
        if not self.odd and x.isascii() and x.replace(",", "").isdigit():
            return NUMERIC if "," in x else PLAIN
        n = normal(x)
        labels: list[tuple[slice | None, slice | None] | None] = [None] * 3
        for k in self.asked if self.odd or n.startswith(self.head) else ():
            if self.odd or n.startswith(self.heads[k]) and self.opens[k].match(n):
                labels[k] = self.label_places(x, n, k)
        total = None
        if n.startswith(TOTAL_LABELS):
            m = FIRST_NUMBER.search(x)
            total = next(name for name, y in TOTALS.items() if n.startswith(tuple(y))), slice(*m.span()) if m else None
        date = next((slice(*m.span()) for p in DATES if (m := p.search(x))), None) if self.dated and "date" in x.lower() else None
        description, price, stop = _has(n, DESCRIPTION_MARKS), _has(n, PRICE_MARKS), _has(n, STOP_MARKS)
        if total is None and date is None and not (description or price or stop) and not any(labels):
            return PLAIN
        return Line(labels if any(labels) else None, total, date, description, price, stop, total is not None and n.startswith(ENDS))

    def cell(self, x: str) -> Cell:
        """Facts of a table's line that is not known yet."""
        if not self.strict and "," in x and x.isascii() and x.replace(",", "").isdigit():
            return NUMBER
        s, n = x.strip(), normal(x)
        out = Cell()
        out.money = self.money(x)
        out.start, out.unit, out.note = bool(ITEM_NUMBER.fullmatch(s)), bool(UNIT_WORD.fullmatch(s)), n in ("note", "notes")
        out.drop = n.startswith(TOTAL_LABELS) or bool(re.fullmatch(r"[•●▪*-]", x))
        out.fielded = bool(FIELD_LABEL.search(x))
        m = QUANTITY.fullmatch(s)
        out.quantity = (float(m[1]), m[2]) if m else None
        out.bare, out.digits = bool(BARE_NUMBER.fullmatch(s)), bool(re.fullmatch(r"[\d.,]+", s))
        out.price = out.money is not None or n in PRICE_WORDS
        if out.fielded:
            found, left = labelled_fields([x])
            ends = list(FIELD_LABEL.finditer(x))[-1].end()
            out.fields = found if not left and x[ends:].strip(" ,;:-|") else None  # else a line around it has a part in it
        if out.note or out.fielded and out.fields is None and not out.drop:
            out.alike = None
        else:
            # texts count where they are compared: a price that is no number by its look, and a unit
            kind = (out.drop, out.fields is not None, out.bare, out.unit, s if out.unit else out.quantity and out.quantity[1], out.price, out.digits, x if out.price and not out.digits else None)
            if len(self.kinds) >= KNOWN:
                self.kinds.clear()
            out.alike = self.kinds.get(kind) or self.kinds.setdefault(kind, next(self.unused))
        if len(self.cells) >= KNOWN:
            self.cells.clear()
        self.cells[x] = out
        return out

    def cells_of(self, lines: list[str], facts: list[Line | bool | None] | None = None) -> list[Cell]:
        """``facts``: those of the lines, if they were found."""
        cells = self.cells
        if facts is None or self.strict:
            return [cells[x] for x in lines]
        return [NUMBER if f is NUMERIC else cells[x] for x, f in zip(lines, facts, strict=True)]

    def shapes(self, lines: list[str]) -> list[str]:
        # bytes, as a table replaces these faster
        out = "\n".join(lines).encode("utf-8", "surrogatepass").translate(self.shape).decode("utf-8", "surrogatepass").split("\n")
        return out if len(out) == len(lines) else [y for x in lines for y in (self.shapes([x]) if "\n" not in x else [x])]

    def labelled(self, lines: list[str], shapes: list[str], labels: list[tuple[int, list]], k: int, scan: int, ahead: int = 6) -> str:
        """The first value in the first ``scan`` lines: behind a label on its line, else the next usable line."""
        for i, found in labels:
            if i >= scan:
                break
            places = found[k]
            if places is None:
                continue
            x = lines[i]
            first, other = [self.label_values(x, normal(x), k)[j][0] if at is AGAIN else x[at] for j, at in enumerate(places)]
            if first:
                return first
            skips = self.skips[k]
            following = next((lines[j] for j in range(i + 1, min(i + 1 + ahead, len(lines))) if not skips[shapes[j]]), "")
            if following:
                return BLANKS.sub(" ", following).strip(" :-|")
            if other:
                return other
        return ""

    def header(self, lines: list[str], marked: list[tuple[int, Line]]) -> tuple[int, dict[str, str]]:
        """Line number and named columns of the first table header: one to three lines that name a description and a price."""
        described, priced, after = [i for i, f in marked if f.description], {i for i, f in marked if f.price}, 0
        for at in described:
            for i in range(max(after, at - 2), at + 1):
                if priced.isdisjoint((i, i + 1, i + 2)):
                    continue
                found = header_names(tuple(lines[i : i + 3]))
                if found is not None:
                    return i, found
            after = at + 1
        return -1, {}

    def starts(self, region: list[str], cells: list[Cell]) -> list[int]:
        """Lines that are an item number alone, not part of a note's list and not a quantity whose unit is on the next line."""
        out = [i for i, c in enumerate(cells) if c.start and not (i + 1 < len(cells) and cells[i + 1].unit)]
        if out and any([c.note for c in cells]):  # noqa: C419  a generator costs more
            notes = note_lines(region)
            out = [i for i in out if i not in notes]
        return out

    def begun(self, region: list[str], facts: list[Line | bool | None]) -> bool:
        """Whether any item starts; only lines behind a note can be of its list, so the first start before one settles it."""
        cells = self.cells
        for i, (x, f) in enumerate(zip(region, facts, strict=True)):
            if f is NUMERIC:
                continue
            c = cells[x]
            if c.note:
                return bool(self.starts(region, self.cells_of(region)))
            if c.start and not (i + 1 < len(region) and cells[region[i + 1]].unit):
                return True
        return False

    def plan(self, lines: list[str], cells: list[Cell], rest: list[int], fields: list[int]) -> Plan:
        """Which of the lines ``rest`` says what."""
        quantity = unit = None
        said = ""
        for i in rest:
            if cells[i].quantity:
                quantity, said = i, cells[i].quantity[1]
                break
        else:
            bare = [k for k, i in enumerate(rest) if cells[i].bare]
            pair = next((k for k in bare if k + 1 < len(rest) and cells[rest[k + 1]].unit), None)
            if pair is not None:
                quantity, unit = rest[pair], rest[pair + 1]
                said = lines[unit].strip()
            elif bare:
                quantity = rest[bare[0]]
        values = [i for i in rest if cells[i].price and i != quantity and i != unit and lines[i].strip() != said]
        a, b = values[-2:] if len(values) >= 2 else (None, *values[:1]) if values else (None, None)
        warning = "" if a is not None else "ONLY_ONE_VALUE" if values else "NO_PRICE_VALUES"
        prices = [lines[i] for i in (a, b) if i is not None]
        words = [i for i in rest if i != quantity and i != unit and not cells[i].digits and lines[i] not in prices]
        full = words and quantity is not None and said and a is not None
        confidence = "HIGH" if full else "MEDIUM" if words and (quantity is not None or values) else "LOW"
        return Plan(words, fields, quantity, unit, a, b, confidence, warning)

    def item(self, block: list[str], cells: list[Cell], number: int) -> Item:
        """One item from the lines between two item numbers.  Items whose lines are alike have one plan."""
        lines, facts, own = block, cells, {}
        key = tuple([c.alike for c in cells[1:]])
        plan = self.plans.get(key)
        if plan is None and None in key:
            notes = note_lines(block) if any(c.note for c in cells) else ()
            lines = [block[i] for i in range(1, len(block)) if not cells[i].drop and i not in notes]
            if any(FIELD_LABEL.search(x) for x in lines):
                own, lines = labelled_fields(lines)
            facts = self.cells_of(lines)
            plan = self.plan(lines, facts, list(range(len(lines))), [])
        elif plan is None:
            kept = [i for i in range(1, len(block)) if not cells[i].drop]
            plan = self.plan(block, cells, [i for i in kept if cells[i].fields is None], [i for i in kept if cells[i].fields is not None])
            if len(self.plans) >= KNOWN:
                self.plans.clear()
            self.plans[key] = plan
        words, fields, q, u, a, b, confidence, warning = plan
        for i in fields:
            own = facts[i].fields | own
        glued = facts[q].quantity if q is not None else None
        return Item(
            block[0].strip(),
            "\n".join([lines[i] for i in words]),
            own,
            glued[0] if glued else float(lines[q]) if q is not None else None,
            glued[1] if glued else lines[u].strip() if u is not None else "",
            lines[a] if a is not None else "",
            None if a is None else facts[a].money if facts[a] is not NUMBER else float(lines[a].replace(",", "")),
            lines[b] if b is not None else "",
            None if b is None else facts[b].money if facts[b] is not NUMBER else float(lines[b].replace(",", "")),
            " | ".join(block),
            confidence,
            warning and f"ITEM_{number}_{warning}",
        )

    def document(self, lines: list[str]) -> dict:
        """Fields, totals, items, warnings and confidence of a document, as far as they are wanted."""
        lines = list(filter(None, map(str.strip, lines)))
        shapes = self.shapes(lines)
        facts = list(map(self.lines.__getitem__, shapes))
        marked = list(compress(enumerate(facts), facts))
        labels = [(i, f.labels) for i, f in marked if f.labels is not None]
        out: dict = {}
        if 0 in self.asked:
            customer = self.labelled(lines, shapes, labels, 0, 60)
            how = "HIGH" if customer else "LOW"
            if not customer and (m := next((m for x in lines[:60] if x[0] in "mM" and (m := MESSRS.match(x))), None)):
                customer, how = m[0].strip(), "MEDIUM"
            out |= {"customer": customer, "customer_confidence": how}
        if 2 in self.asked:
            number = self.labelled(lines, shapes, labels, 2, 80)
            out["quotation_number"] = DATED.sub("", words[0]).rsplit("-", 1)[-1] if (words := number.split()) else ""
        if 1 in self.asked:
            out["subject"] = self.labelled(lines, shapes, labels, 1, 80)
        if self.dated:
            out["quotation_date"] = next((lines[i][f.date] for i, f in marked if f.date is not None and i < 100), "")
        out |= NO_TOTALS
        for i, f in marked:
            if f.total is not None and f.total[1] is not None:
                out[f.total[0]] = float(lines[i][f.total[1]].replace(",", ""))
        header, named = self.header(shapes, marked)
        out |= {"boq_detected": header >= 0, "boq_headers": "; ".join(named)}
        items: list[Item] = []
        begun = False
        if header >= 0 and (self.judged or self.wanted):
            # the table goes on up to a stop mark, or with the first total
            end = next((i + (not f.stop) for i, f in marked if i > header and (f.stop or f.end)), len(lines))
            region, said = lines[header + 1 : end], facts[header + 1 : end]
            if self.wanted:
                cells = self.cells_of(region, said)
                starts = self.starts(region, cells)
                begun = bool(starts)
                items = [self.item(region[a:b], cells[a:b], i + 1) for i, (a, b) in enumerate(zip(starts, [*starts[1:], len(region)], strict=False))]
            else:
                begun = self.begun(region, said)
        if self.judged:
            points = bool(out["customer"]) + bool(out["subject"]) + bool(out["quotation_number"]) + 2 * (header >= 0) + 2 * begun
            out["document_confidence"] = "HIGH" if points >= 6 else "MEDIUM" if points >= 4 else "LOW"
        return out | {"warnings": [i.warning for i in items if i.warning], "items": items}


def item_starts(region: list[str]) -> list[int]:
    """Lines of a table's region that begin an item."""
    reader = Reader()
    return reader.starts(region, reader.cells_of(region))


@functools.lru_cache(8)
def _reader(strict: bool, number_labels: tuple[str, ...]) -> Reader:
    return Reader(strict, list(number_labels))


def parse_lines(lines: list[str], strict: bool = False, number_labels: list[str] = NUMBER_LABELS) -> dict:
    """Fields, totals, items, warnings and confidence of a document."""
    found = _reader(strict, tuple(number_labels)).document(lines)
    return {f: found[f] for f in FIELDS}


ITEM_DDL = "item_no string, description string, product string, make string, model string, version string, quantity double, unit string, unit_price_raw string, unit_price double, total_price_raw string, total_price double, raw_row_text string, confidence string"
ITEM_KINDS = dict(x.split() for x in ITEM_DDL.split(", "))
TEXTS = ["customer", "customer_confidence", "subject", "quotation_number", "quotation_date", "boq_headers", "document_confidence"]
NUMBERS = ["subtotal", "tax", "discount", "grand_total"]
ARROW = {"string": pa.string(), "double": pa.float64(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}


def _named(fields: list[str]) -> list[tuple[str, str, bool]]:
    """(field, its name in an item, whether it is a labelled one)."""
    return [(f, "raw" if f == "raw_row_text" else f, f in ITEM_FIELDS) for f in fields]


def _put(cells: dict[str, list], named: list[tuple[str, str, bool]], items: list[Item]) -> None:
    """Append the items to their columns."""
    for f, name, labelled in named if items else ():
        cells[f] += [i.fields.get(f, "") for i in items] if labelled else map(attrgetter(name), items)


def parse_documents(docs: DataFrame, path: str = "source_path", text: str = "text", strict: bool = False, only: list[str] | None = None, item_fields: list[str] | None = None) -> DataFrame:
    """One row per document with its fields, ``items`` (an array), ``warnings`` and ``error``; one document's failure stays its own.

    ``only`` names the columns beside the path that are wanted, ``item_fields`` the fields of items; by default all.
    """
    names = only if only is not None else [*TEXTS, *NUMBERS, "boq_detected", "warnings", "items", "error"]
    fields = item_fields or list(ITEM_KINDS)
    ddl = {c: "string" for c in [*TEXTS, "error"]} | {c: "double" for c in NUMBERS} | {"boq_detected": "boolean", "warnings": "array<string>", "items": f"array<struct<{','.join(f'{f}:{ITEM_KINDS[f]}' for f in fields)}>>"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(strict, only=names)
        named = _named(fields)
        plain = [c for c in names if c != "items"]
        for batch in batches:
            # values go to their columns at once: a batch's worth of objects would be walked over and over by the garbage collector
            values: dict[str, list] = {c: [] for c in plain}
            cells: dict[str, list] = {f: [] for f in fields}
            ends = [0]
            for t in batch.column(1).to_pylist():
                try:
                    found = reader.document((t or "").splitlines())
                except Exception as e:  # noqa: BLE001  the document's row tells
                    found = {"boq_detected": False, "items": [], "warnings": [], "error": f"PARSER_ERROR: {e}"}
                for c in plain:
                    values[c].append(found.get(c))
                _put(cells, named, found["items"])
                ends.append(ends[-1] + len(found["items"]))
            columns = {c: pa.array(values[c], ARROW[ddl[c]]) for c in plain}
            if "items" in names:
                columns["items"] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(cells[f], ARROW[ITEM_KINDS[f]]) for f in fields], fields))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(columns[c] for c in names)], names=[path, *names])

    schema = f"{path} string, " + ", ".join(f"{c} {ddl[c]}" for c in names)
    return docs.select(F.col(path).cast("string"), F.col(text).cast("string")).mapInArrow(run, schema)


def parse_items(docs: DataFrame, path: str = "source_path", text: str = "text", strict: bool = False, item_fields: list[str] | None = None) -> DataFrame:
    """``items_of(parse_documents(...))`` without the document's number: one row per item, made as rows at once instead of arrays to take apart."""
    fields = item_fields or list(ITEM_KINDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, named = Reader(strict, only=["items"]), _named(fields)
        for batch in batches:
            cells: dict[str, list] = {f: [] for f in fields}
            of: list[int] = []
            ordinals: list[int] = []
            made: list[Item] = []
            for k, t in enumerate(batch.column(1).to_pylist()):
                try:
                    items = reader.document((t or "").splitlines())["items"]
                except Exception:  # noqa: BLE001, S112  parse_documents has the document's error
                    continue
                of += [k] * len(items)
                ordinals += range(len(items))
                made += items
                if len(made) > 500:  # few enough for the garbage collector
                    _put(cells, named, made)
                    made.clear()
            _put(cells, named, made)
            columns = [pa.array(cells[f], ARROW[ITEM_KINDS[f]]) for f in fields]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of, pa.int32())), pa.array(ordinals, pa.int32()), *columns], names=[path, "ordinal", *fields])

    schema = f"{path} string, ordinal int, " + ", ".join(f"{f} {ITEM_KINDS[f]}" for f in fields)
    return docs.select(F.col(path).cast("string"), F.col(text).cast("string")).mapInArrow(run, schema)


def items_of(parsed: DataFrame, path: str = "source_path") -> DataFrame:
    """One row per item: the path, the document's number if it was read, its position and its fields."""
    kept = [path, *(["quotation_number"] if "quotation_number" in parsed.columns else [])]
    return parsed.select(*kept, F.posexplode("items").alias("ordinal", "i")).select(*kept, "ordinal", "i.*")


#: What ``review_of`` needs of a document and of its items.
REVIEWED, REVIEWED_ITEM = ["customer", "subject", "boq_detected", "warnings", "items", "error"], ["confidence"]


def review_of(parsed: DataFrame, path: str = "source_path") -> DataFrame:
    """(path, kind, reason): missing customer, subject or table, warnings, items below HIGH, and failures; documents are read once."""
    told = lambda kind, reason: F.struct(F.lit(kind).alias("kind"), reason.alias("reason"))
    when = lambda test, reason: F.when(test, told("document", reason))
    read = F.col("error").isNull()
    single = F.array(
        when(read & (F.col("customer") == ""), F.lit("CUSTOMER_MISSING")),
        when(read & (F.col("subject") == ""), F.lit("SUBJECT_MISSING")),
        when(read & ~F.col("boq_detected"), F.lit("TABLE_MISSING")),
        when(~read, F.col("error")),
    )
    low = F.filter(F.col("items.confidence"), lambda x: x != "HIGH")
    reasons = F.concat(F.array_compact(single), F.transform("warnings", lambda w: told("document", w)), F.transform(low, lambda x: told("item", F.concat(F.lit("ITEM_CONFIDENCE_"), x))))
    return parsed.select(path, F.explode(reasons).alias("r")).select(path, "r.kind", "r.reason")
