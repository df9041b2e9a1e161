"""Records from stored web pages, one Spark task per batch of pages.

Rules name a tag to look for. Python only walks the tags of the pages, tag by tag of many pages at once where it can, and returns texts and
attributes; numbers, identifiers and structs are made from them by column expressions.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions import markup, text
from .guards import require_columns
from .keyed import last_wins

# HTML elements that never have an end tag.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


@dataclass(frozen=True)
class Rule:
    """Texts (or an attribute) of the tags that match, or of `inner` tags within them.

    The first match counts unless `every` is set; `every_inner` does the same for inner tags. `part` lets
    `value` match a part of a class name; `has` names an attribute that must be there too. The tag `*` is any tag.
    """

    name: str
    tag: str
    attribute: str = ""
    value: str = ""
    inner: str = ""
    take: str = "text"
    every: bool = False
    every_inner: bool = False
    part: bool = False
    has: str = ""

    def matches(self, tag: str, attributes: dict[str, str]) -> bool:
        if self.tag not in (tag, "*") or self.has and self.has not in attributes:
            return False
        if not self.attribute:
            return True
        found = attributes.get(self.attribute)
        if found is None:
            return False
        words = found.split()
        if self.part:
            return any(self.value in word for word in words)
        return found == self.value or self.value in words


# Where the pages keep each field.
TITLE_RULES = [
    Rule("original_title", "h1", "data-testid", "hero-title-block__title"),
    Rule("poster_url", "div", "data-testid", "hero-media__poster", inner="img", take="src"),
    Rule("scores", "span", "class", "score", every=True),
    Rule("rating_text", "div", "data-testid", "hero-rating-bar__aggregate-rating"),
    Rule("actor_links", "a", "data-testid", "title-cast-item__actor", take="href", every=True),
    Rule("similar_links", "a", "class", "ipc-poster-card__title", take="href", every=True, part=True),
    Rule("genres", "div", "data-testid", "genres", inner="a", every_inner=True),
    Rule("release_date", "li", "data-testid", "title-details-releasedate", inner="li", every_inner=True),
    Rule("countries_of_origin", "li", "data-testid", "title-details-origin", inner="li", every_inner=True),
    Rule("language", "li", "data-testid", "title-details-languages", inner="li", every_inner=True),
    Rule("also_known_as", "li", "data-testid", "title-details-akas", inner="li", every_inner=True),
    Rule("production_companies", "li", "data-testid", "title-details-companies", inner="li", every_inner=True),
    Rule("filming_locations", "li", "data-testid", "title-details-filminglocations", inner="li", every_inner=True),
    Rule("runtime", "li", "data-testid", "title-techspec_runtime", inner="div"),
    Rule("budget", "li", "data-testid", "title-boxoffice-budget", inner="li"),
    Rule("boxoffice_gross_domestic", "li", "data-testid", "title-boxoffice-grossdomestic", inner="li"),
    Rule("boxoffice_gross_opening", "li", "data-testid", "title-boxoffice-openingweekenddomestic", inner="li"),
    Rule("boxoffice_gross_worldwide", "li", "data-testid", "title-boxoffice-cumulativeworldwidegross", inner="li"),
]
REVIEW_SCOPE = Rule("review", "div", "class", "review-container", every=True)
REVIEW_RULES = [
    Rule("text", "div", "class", "text show-more__control"),
    Rule("spans", "span", every=True),
    Rule("date", "span", "class", "review-date"),
    Rule("title", "a", "class", "title"),
    Rule("author", "span", "class", "display-name-link", inner="a", take="href"),
    Rule("helpfulness", "div", "class", "actions text-muted"),
]
LISTING_SCOPE = Rule("item", "div", "class", "lister-item-content", every=True)
LISTING_RULES = [Rule("link", "a", take="href"), Rule("genres", "span", "class", "genre")]
REVIEW_LIST_RULES = [
    Rule("total", "div", "class", "header", inner="div"),
    Rule("next_key", "*", "class", "load-more-data", take="data-key", has="data-key"),
]
TOP_ACTORS = 10
MOST_TAGS = 20_000  # written tags whose meaning is remembered by a reader
MOST_STEPS = 50_000  # steps from tag to tag that are remembered by a reader
MOST_CELLS = 1 << 22  # of the table in which they are found for many pages at once
BYTES_AT_ONCE = 1 << 24  # of pages read at once
FEW_PAGES = 16  # pages for which reading many at once is not worth it
SCORE_NAMES = ["user_review_num", "critic_review_num", "metascore"]


# A comment or declaration, a script or style with its content, or one tag with quoted attribute values.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>",
    re.S | re.I,
)
BY_TURNS = re.compile(r"[^<>]*+(?:<[^<>]*+>[^<>]*+)*+")
BY_TURNS_ONLY = r"\A[^<>]*(?:<[^<>]*>[^<>]*)*\z"  # the same as Arrow writes it
# A tag that ends at the first > whatever follows, without its signs. Scripts and styles go on beyond theirs.
PLAIN_TAG = re.compile(
    r"(?!(?:script|style)\b)(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>\"']*)(?=[\s/]|\Z)(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.S)


def _attributes(written: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(written)}


# What a reader does at a tag: which of the open records, which rule, which attribute or how many texts are open already.
TEXT, ATTRIBUTE_OF, PRESENT, SCOPE, TEXTS_LEFT, SCOPES_LEFT = range(6)


class Kind:
    """Tags that mean the same: their name, whether they are end tags, the rules on them, whether they are the scope, and which attributes they give."""

    __slots__ = ("name", "end", "rules", "is_scope", "given")

    def __init__(self, name: str, end: bool, rules: tuple[Rule, ...], is_scope: bool, given: frozenset[str]):
        self.name, self.end, self.rules, self.is_scope, self.given = name, end, rules, is_scope, given


class Chain:
    """A stack that shares what lies below its top with others; equal stacks are one object."""

    __slots__ = ("top", "below", "size", "above")

    def __init__(self, top=None, below: Chain | None = None):
        self.top, self.below, self.above = top, below, {}
        self.size = below.size + 1 if below else 0

    def push(self, top) -> Chain:
        found = self.above.get(top)
        if found is None:
            found = self.above[top] = Chain(top, self)
        return found


@dataclass(frozen=True)
class Scope:
    """An open scope tag: its depth, the rules with values in its record, those with a list (also an empty one), and the rules whose tag is open in it."""

    depth: int
    filled: frozenset[str] = frozenset()
    present: frozenset[str] = frozenset()
    inside: tuple[tuple[Rule, int], ...] = ()


class State(dict):
    """Where a reader stands on a page: the open tags, scopes and depths of texts being read. Kind of the next tag -> what to do, the state then, whether a
    text is being read there."""

    __slots__ = ("open", "scopes", "texts")


class PageReader:
    """Collects, per scope, a list of values for every rule whose tag occurs on a page. Scopes may lie in each other.

    What a tag does depends on its kind and on where it stands, and pages repeat both. So each step is worked out once, and remembered.
    """

    def __init__(self, rules: list[Rule], scope: Rule | None = None):
        self.scope, self.rules = scope, rules
        self.by_tag: dict[str, list[Rule]] = {}
        for rule in rules:
            self.by_tag.setdefault(rule.tag, []).append(rule)
        self.inner_tags = {rule.inner for rule in rules}
        self.taken = {rule.take for rule in rules} - {"text"}
        # What must be written in a tag for any rule on it to match; an empty text is in every tag.
        self.marks: dict[str, list[str]] = {}
        for rule in [*rules, *([scope] if scope else [])]:
            self.marks.setdefault(rule.tag, []).append(rule.value.split(" ")[0])
        self.any_marks = self.marks.get("*", [])
        # Pages of a site repeat their tags: what is written in a plain tag, or the parts of any tag -> its kind and attributes.
        self.known: dict[str | tuple[str, str, str], tuple[Kind, dict[str, str]]] = {}
        self._forget()

    def _forget(self) -> None:
        self.kinds: dict[tuple, Kind] = {}
        self.states: dict[tuple, State] = {}
        self.held = 0
        self.table = None
        first = () if self.scope else (Scope(0),)
        self.start = self._state(Chain(), first, Chain())

    def read(self, page: str) -> list[dict]:
        # Where signs stand only around tags, what lies between them is a tag and a text by turns.
        tags = [None]
        if BY_TURNS.fullmatch(page):
            parts = page.replace(">", "<").split("<")
            written, texts = parts[1::2], parts[2::2]
            tags = list(map(self.known.get, written))
            if None in tags:
                tags = [self._plain(w) if t is None else t for w, t in zip(written, tags)]
        if None in tags:
            tags, texts = self._by_pattern(page)
        records: list[dict] = [] if self.scope else [{}]
        open_records, reading = records.copy(), []  # of the open scopes; the lists and places of the texts being read
        state = self.start
        for (kind, attributes), text in zip(tags, texts):
            step = state.get(kind)
            if step is None:
                step = self._step(state, kind)
            actions, state, is_text = step
            for action, at, name, take in actions:
                if action == TEXTS_LEFT:
                    del reading[at:]
                elif action == SCOPE:
                    open_records.append({})
                    records.append(open_records[-1])
                elif action == SCOPES_LEFT:
                    del open_records[at:]
                else:
                    values = open_records[at].get(name)
                    if values is None:
                        values = open_records[at][name] = []
                    if action == TEXT:
                        reading.append((values, len(values)))
                        values.append("")
                    elif action == ATTRIBUTE_OF:
                        values.append(attributes[take])
            if is_text and text:
                if "&" in text:
                    text = html.unescape(text)
                for values, place in reading:
                    values[place] += text
        return records

    def _by_pattern(self, page: str) -> tuple[list, list[str]]:
        """The tags of a page and the texts after them; comments, declarations, scripts and styles only part texts."""
        pieces = TOKEN.split(page)
        parts, texts = list(zip(pieces[2::5], pieces[3::5], pieces[4::5])), pieces[5::5]
        return [self.known.get(p) or self._remembered(p, *p) for p in parts], texts

    def _plain(self, written: str) -> tuple[Kind, dict[str, str]] | None:
        """The meaning of what is written between < and the next >; None if more may belong to it."""
        if written[:1] in ("!", "?"):
            whole = not written.startswith("!--") or len(written) > 4 and written.endswith("--")
            return self._remembered(written, None, None, None) if whole else None
        found = PLAIN_TAG.fullmatch(written)
        return self._remembered(written, *found.group("end", "tag", "attributes")) if found else None

    def _remembered(self, key, end: str | None, tag: str | None, attributes: str | None) -> tuple[Kind, dict[str, str]]:
        if len(self.known) >= MOST_TAGS:
            self.known.clear()
        # What is no tag does as little as the end of a tag that cannot be open.
        self.known[key] = meaning = self._meaning(True, "", "") if tag is None else self._meaning(bool(end), tag, attributes)
        return meaning

    def _meaning(self, end: bool, tag: str, written: str) -> tuple[Kind, dict[str, str]]:
        """The kind of a tag and those of its attributes that rules take."""
        name = tag.lower()
        if end:
            return self._kind(name, True, (), False, frozenset()), {}
        marks = self.marks.get(name, ())
        if not (name in self.inner_tags or "&" in written or any(m in written for m in marks) or any(m in written for m in self.any_marks)):
            return self._kind(name, False, (), False, frozenset()), {}  # no rule asks for its attributes
        attributes = _attributes(written)
        rules = tuple(r for r in [*self.by_tag.get(name, ()), *self.by_tag.get("*", ())] if r.matches(name, attributes))
        is_scope = self.scope is not None and self.scope.matches(name, attributes)
        given = {a: v for a, v in attributes.items() if a in self.taken}
        return self._kind(name, False, rules, is_scope, frozenset(given)), given

    def _kind(self, *parts) -> Kind:
        found = self.kinds.get(parts)
        if found is None:
            if len(self.kinds) >= MOST_TAGS:
                self._forget()
            found = self.kinds[parts] = Kind(*parts)
        return found

    def _state(self, open: Chain, scopes: tuple[Scope, ...], texts: Chain) -> State:
        found = self.states.get((open, scopes, texts))
        if found is None:
            found = self.states[open, scopes, texts] = State()
            found.open, found.scopes, found.texts = open, scopes, texts
        return found

    def _step(self, state: State, kind: Kind) -> tuple[list[tuple], State, bool]:
        if self.held >= MOST_STEPS:
            self._forget()
        actions: list[tuple] = []
        then = self._state(*(self._end if kind.end else self._start)(state, kind, actions))
        self.held += 1 + len(then.scopes)
        state[kind] = step = actions, then, then.texts.size > 0
        return step

    def _start(self, state: State, kind: Kind, actions: list[tuple]) -> tuple[Chain, tuple[Scope, ...], Chain]:
        open = state.open if kind.name in VOID else state.open.push(kind.name)
        scopes, texts = [], state.texts

        def take(at: int, rule: Rule, filled: set[str]) -> None:
            nonlocal texts
            if rule.take == "text":
                actions.append((TEXT, at, rule.name, texts.size))
                texts = texts.push(open.size)
            elif rule.take in kind.given:
                actions.append((ATTRIBUTE_OF, at, rule.name, rule.take))
            else:
                actions.append((PRESENT, at, rule.name, ""))
                return
            filled.add(rule.name)

        for at, scope in enumerate(state.scopes):
            filled, present, inside = set(scope.filled), set(scope.present), list(scope.inside)
            held = [rule for rule, _ in scope.inside]
            for rule in held:
                if rule.inner == kind.name and (rule.every_inner or rule.name not in filled):
                    take(at, rule, filled)
            for rule in kind.rules:
                if rule not in held and (rule.every or rule.name not in present):
                    present.add(rule.name)
                    if rule.inner:
                        inside.append((rule, open.size))
                        actions.append((PRESENT, at, rule.name, ""))
                    else:
                        take(at, rule, filled)
            scopes.append(Scope(scope.depth, frozenset(filled), frozenset(present), tuple(inside)))
        if kind.is_scope:
            scopes.append(Scope(open.size))
            actions.append((SCOPE, len(state.scopes), "", ""))
        return open, tuple(scopes), texts

    def _end(self, state: State, kind: Kind, actions: list[tuple]) -> tuple[Chain, tuple[Scope, ...], Chain]:
        open, scopes, texts = state.open, list(state.scopes), state.texts
        while open.size and open.top != kind.name:
            open = open.below
        if not open.size:
            return state.open, state.scopes, texts
        open = open.below
        while texts.size and texts.top > open.size:
            texts = texts.below
        if texts is not state.texts:
            actions.append((TEXTS_LEFT, texts.size, "", ""))
        while self.scope and scopes and scopes[-1].depth > open.size:
            scopes.pop()
        if len(scopes) < len(state.scopes):
            actions.append((SCOPES_LEFT, len(scopes), "", ""))
        left = (Scope(s.depth, s.filled, s.present, tuple((rule, d) for rule, d in s.inside if d <= open.size)) for s in scopes)
        return open, tuple(left), texts


class Table:
    """The steps of a reader as numbers, for many pages at once: state and kind -> step; step -> state, and where its actions lie."""

    def __init__(self, start: State):
        self.states: list[State] = []
        self.state_numbers: dict[int, int] = {}  # by identity
        self.kinds: dict[Kind, int] = {}
        self.steps = np.full((64, 64), -1, np.int32)
        self.then = np.zeros(64, np.int64)
        self.first: list[int] = [0]
        self.actions: list[tuple] = []
        self.state(start)

    def state(self, state: State) -> int:
        number = self.state_numbers.get(id(state))
        if number is None:
            number = self.state_numbers[id(state)] = len(self.states)
            self.states.append(state)
        return number

    def add(self, state: int, kind: int, actions: list[tuple], then: State) -> None:
        number = len(self.first) - 1
        if number == len(self.then):
            self.then = np.append(self.then, np.zeros(number, np.int64))
        self.steps[state, kind], self.then[number] = number, self.state(then)
        self.actions += actions
        self.first.append(len(self.actions))

    def room(self) -> bool:
        """Makes room for as many states and kinds as there are; False if that would be too much."""
        rows, columns = (1 << max(6, size.bit_length()) for size in (len(self.states), len(self.kinds)))
        if rows * columns > MOST_CELLS:
            return False
        old = self.steps
        if rows > old.shape[0] or columns > old.shape[1]:
            self.steps = np.full((max(rows, old.shape[0]), max(columns, old.shape[1])), -1, np.int32)
            self.steps[: old.shape[0], : old.shape[1]] = old
        return True


def read_many(reader: PageReader, names: list[str], pages: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[pa.Array]]:
    """What `reader` reads on many pages, all at once: which of them were read, the page and position of each record, and its lists by rule.

    Left to the reader itself are pages on which signs do not stand by turns, and those that are much longer than the others.
    """
    none = np.zeros(len(pages), bool), np.zeros(0, np.int64), np.zeros(0, np.int32), []
    turns = pc.match_substring_regex(pages, BY_TURNS_ONLY).fill_null(False).to_numpy(zero_copy_only=False)
    number = np.flatnonzero(turns)
    parts = pc.split_pattern(pc.replace_substring(pages.take(pa.array(number)), ">", "<"), "<")
    begin = parts.offsets.to_numpy().astype(np.int64)
    flat, size = parts.values, np.diff(begin) // 2
    few = np.sort(size)[-FEW_PAGES] if len(size) >= FEW_PAGES else 0
    page = np.repeat(np.arange(len(size)), size)
    words = flat.take(pa.array(begin[page] + 1 + 2 * _places(size))).dictionary_encode()
    word = words.indices.to_numpy(zero_copy_only=False)
    meanings = [reader.known.get(w) or reader._plain(w) for w in words.dictionary.to_pylist()]
    odd = np.array([m is None for m in meanings], bool)
    fine = size <= few
    fine[page[odd[word]]] = False
    if not fine.any():
        return none
    if reader.table is None:
        reader.table = Table(reader.start)
    table = reader.table
    of_word = np.array([-1 if m is None else table.kinds.setdefault(m[0], len(table.kinds)) for m in meanings], np.int64)
    kept = fine[page]
    number, begin, size, word = number[fine], begin[:-1][fine], size[fine], word[kept]
    page = np.repeat(np.arange(len(size)), size)
    place, last = _places(size), np.cumsum(size)
    kind, step = of_word[word], np.zeros(len(page), np.int64)
    kinds = list(table.kinds)
    # One tag of all pages after the other, those with the most tags first.
    state, order = np.zeros(len(size), np.int64), np.argsort(-size, kind="stable")
    active = np.searchsorted(-size[order], -np.arange(size.max(initial=0)), side="left")
    for i, many in enumerate(active):
        here = order[:many]
        at = last[here] - size[here] + i
        if not table.room():
            reader.table = None
            return none
        found = table.steps[state[here], kind[at]]
        unknown = np.flatnonzero(found < 0)
        if len(unknown):
            for s, k in set(zip(state[here[unknown]].tolist(), kind[at[unknown]].tolist())):
                actions, then, _ = table.states[s].get(kinds[k]) or reader._step(table.states[s], kinds[k])
                table.add(s, k, actions, then)
            found = table.steps[state[here], kind[at]]
        step[at] = found
        state[here] = table.then[found]
    read = np.zeros(len(pages), bool)
    read[number] = True
    return read, *_records(reader, names, table, number, page, size, step, flat, begin, place, word, meanings)


def _places(sizes: np.ndarray) -> np.ndarray:
    """0, 1, .. for each of the sizes."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _records(reader, names, table, number, page, size, step, flat, begin, place, word, meanings):
    """Page, position and lists by rule of the records that the steps at the tags give."""
    first = np.array(table.first, np.int64)
    many = np.diff(first)[step]
    tag = np.repeat(np.arange(len(step)), many)
    action = first[step][tag] + _places(many)
    what, at = (np.array([a[i] for a in table.actions], np.int64)[action] for i in (0, 1))
    rules = {name: i for i, name in enumerate(names)}
    rule = np.array([rules.get(a[2], -1) for a in table.actions], np.int64)[action]
    # A record for each scope, or for each page. An action means the last record that was begun as deep in others.
    if reader.scope:
        scope = np.flatnonzero(what == SCOPE)
        owner = page[tag[scope]]
        position = np.arange(len(scope)) - np.searchsorted(owner, owner)
        record = np.full(len(what), -1, np.int64)
        value = np.flatnonzero(rule >= 0)
        for depth in np.unique(at[value]):
            begun, own = scope[at[scope] == depth], value[at[value] == depth]
            record[own] = np.searchsorted(scope, begun)[np.searchsorted(begun, own) - 1]
    else:
        owner, position, record = np.arange(len(size)), np.zeros(len(size), np.int64), page[tag]
    # A text goes on until fewer are open than before it, or to the end of its page.
    text = np.flatnonzero(what == TEXT)
    open_before = np.array([a[3] if a[0] == TEXT else 0 for a in table.actions], np.int64)[action[text]]
    closing, start = np.flatnonzero(what == TEXTS_LEFT), tag[text]
    end = np.cumsum(size)[page[start]]
    for depth in np.unique(open_before):
        own = np.flatnonzero(open_before == depth)
        closes = np.append(tag[closing[at[closing] <= depth]], len(step))
        end[own] = np.minimum(end[own], closes[np.searchsorted(closes, start[own], side="right")])
    length = end - start
    piece = np.repeat(start, length) + _places(length)
    pieces = flat.take(pa.array(begin[page[piece]] + 2 + 2 * place[piece]))
    written = pc.match_substring(pieces, "&")
    pieces = pc.replace_with_mask(pieces, written, pa.array([html.unescape(t) for t in pieces.filter(written).to_pylist()], pa.string()))
    texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(length)), pa.int32()), pieces), "")
    text_of = np.zeros(len(what), np.int64)
    text_of[text] = np.arange(len(text))
    takes, lists = {r.name: r.take for r in reader.rules}, []
    for i, name in enumerate(names):
        mine = np.flatnonzero(rule == i)
        present = np.bincount(record[mine], minlength=len(owner)) > 0
        given = mine[what[mine] != PRESENT]
        given = given[np.argsort(record[given], kind="stable")]
        if takes[name] == "text":
            values = texts.take(pa.array(text_of[given]))
        else:
            values = pa.array([m and m[1].get(takes[name]) for m in meanings], pa.string()).take(pa.array(word[tag[given]]))
        starts = np.append(0, np.cumsum(np.bincount(record[given], minlength=len(owner))))
        lists.append(pa.ListArray.from_arrays(pa.array(starts, pa.int32(), mask=np.append(~present, False)), values))
    return number[owner], position.astype(np.int32), lists


def extract_pages(pages: DataFrame, rules: list[Rule], scope: Rule | None = None, key: str = "id") -> DataFrame:
    """One row per page, or per scope tag: key, position, and a list of texts per rule (NULL: no such tag)."""
    require_columns(pages, key, "html")
    names = [rule.name for rule in rules]
    texts = T.ArrayType(T.StringType())
    schema = T.StructType([pages.schema[key], T.StructField("position", T.IntegerType()), *(T.StructField(name, texts) for name in names)])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = PageReader(rules, scope)
        for keys, pages in slices(batches):
            read_at_once, *found = read_many(reader, names, pages)
            if read_at_once.any():
                yield rows(keys, *found)
            one_by_one = np.flatnonzero(~read_at_once)
            page, position, lists = [], [], [([], []) for _ in names]
            for i, text in zip(one_by_one.tolist(), pages.take(pa.array(one_by_one)).to_pylist()):
                for place, record in enumerate(reader.read(text or "")):
                    page.append(i)
                    position.append(place)
                    # All values of a rule, and where those of each record begin (None: it has no list).
                    for name, (starts, values) in zip(names, lists):
                        found = record.get(name)
                        if found is None:
                            starts.append(None)
                        else:
                            starts.append(len(values))
                            values += found
            columns = [
                pa.ListArray.from_arrays(pa.array([*starts, len(values)], pa.int32()), pa.array(values, pa.string())) for starts, values in lists
            ]
            yield rows(keys, page, position, columns)

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
        """Keys and pages, as many as are held in memory at once."""
        for batch in batches:
            before = np.cumsum(pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)) // BYTES_AT_ONCE
            cuts = [0, *(np.flatnonzero(np.diff(before)) + 1).tolist(), batch.num_rows]
            for start, end in zip(cuts, cuts[1:]):
                some = batch.slice(start, end - start)
                yield some.column(0), some.column(1).cast(pa.string())

    def rows(keys: pa.Array, page, position, lists: list[pa.Array]) -> pa.RecordBatch:
        page, position = pa.array(page, pa.int64()), pa.array(position, pa.int32())
        return pa.RecordBatch.from_arrays([keys.take(page), position, *lists], names=[key, "position", *names])

    return pages.select(key, "html").mapInArrow(read, schema)


def _first(name: str):
    return F.get(name, F.lit(0)).alias(name)


def _ranked(links: str, limit: int | None = None):
    """rank -> id of the links that carry a rank; of equal ranks the last one counts."""
    used = F.slice(links, 1, limit) if limit else F.col(links)
    entries = F.filter(
        F.transform(used, lambda h: F.struct(text.link_rank(h).alias("rank"), text.link_id(h).alias("id"))),
        lambda e: e["rank"].isNotNull(),
    )
    # One entry per rank: the place of each rank's last link picks it.
    ranks = F.transform(entries, lambda e: e["rank"])
    last = F.filter(entries, lambda e, i: F.array_position(F.reverse(ranks), e["rank"]) == F.size(entries) - i)
    return F.coalesce(F.map_from_entries(last), F.expr("cast(map() as map<string,string>)"))


def title_records(pages: DataFrame, key: str = "id") -> DataFrame:
    """Title pages -> the nested records that cleaning starts from."""
    found = extract_pages(pages, TITLE_RULES, key=key)
    return found.select(
        key,
        _first("original_title"),
        "genres",
        _first("poster_url"),
        markup.scores(F.col("scores"), SCORE_NAMES).alias("review_summary"),
        markup.rating_parts(F.get("rating_text", F.lit(0))).alias("agg_rating"),
        _ranked("actor_links", TOP_ACTORS).alias("actors"),
        _ranked("similar_links").alias("imdb_recommendations"),
        F.struct(
            "release_date",
            "countries_of_origin",
            "language",
            "also_known_as",
            "production_companies",
            "filming_locations",
            _first("runtime"),
        ).alias("details"),
        F.struct(
            _first("budget"),
            _first("boxoffice_gross_domestic"),
            _first("boxoffice_gross_opening"),
            _first("boxoffice_gross_worldwide"),
        ).alias("boxoffice"),
    )


def review_records(pages: DataFrame, key: str = "id") -> DataFrame:
    """Review pages -> raw review rows, one per review block. The rating is the second span of a block."""
    found = extract_pages(pages, REVIEW_RULES, REVIEW_SCOPE, key)
    return found.select(
        key,
        "position",
        _first("text"),
        text.stated_rating(F.get("spans", F.lit(1))).alias("rating"),
        _first("date"),
        _first("title"),
        _first("author"),
        _first("helpfulness"),
    )


def listing(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Listing pages -> (id, main_genre): the first link and the genre text of each listed item.

    An item without a link gives no row, one without a genre NULL. Of an id listed several times the last one counts, by page
    and place on it.
    """
    found = extract_pages(pages, LISTING_RULES, LISTING_SCOPE, key)
    rows = found.select(_first("link"), text.main_genre(F.get("genres", F.lit(0))).alias("main_genre"), key, "position")
    rows = rows.where(F.col("link").isNotNull()).withColumnRenamed("link", "id")
    return last_wins(rows, "id", [key, "position"]).select("id", "main_genre")


def review_lists(pages: DataFrame, key: str = "id") -> DataFrame:
    """Pages that list reviews -> how many reviews their header states (0 without one), and the key of the next page (NULL: none)."""
    found = extract_pages(pages, REVIEW_LIST_RULES, key=key)
    return found.select(key, text.review_total(F.get("total", F.lit(0))).alias("reviews_num"), _first("next_key"))
