"""Brute-force reading of map descriptions for the tests: a hand-written scanner
and plain geometry on the 4 x 4 grid of a section.  Nothing comes from the library."""

from collections import defaultdict

WHOLE = frozenset((row, col) for row in range(4) for col in range(4))
# Where a cell (row from the north, column from the west) of a square of ``size`` lies.
SIDES = {"N": lambda row, col, size: row < size // 2, "S": lambda row, col, size: row >= size // 2,
         "W": lambda row, col, size: col < size // 2, "E": lambda row, col, size: col >= size // 2}


def bits(cells):
    return sum(1 << (4 * row + col) for row, col in cells) if cells is not None else None


def halve(cells, side, size=4):
    """The cells on one side of each square of ``size`` cells."""
    return frozenset((r, c) for r, c in cells if SIDES[side](r % size, c % size, size))


def one_part(word, cells, size):
    """'NE/4' takes two sides of each square, 'N/2' one."""
    for side in word.split("/")[0]:
        cells = halve(cells, side, size)
    return cells


def region(text):
    """Cells named by 'NE/4', 'N/2 SW/4', 'NW/4 SE/4', 'N/2 S/2'; None for other texts."""
    if text == "1/1":
        return WHOLE
    words = text.split()
    if not 1 <= len(words) <= 2 or text != " ".join(words) and len(words) == 1:
        return None
    for w in words:
        sides, _, parts = w.partition("/")
        if not (parts == "2" and sides in tuple("NSEW") or parts == "4" and len(sides) == 2 and sides[0] in "NS" and sides[1] in "EW"):
            return None
    if len(words) == 1:
        return one_part(words[0], WHOLE, 4)
    inner, outer = words
    if outer.endswith("/2") and inner.endswith("/4"):
        return None                                   # no quarter of a half
    if inner.endswith("/2") and outer.endswith("/2"):
        if (inner[0] in "NS") != (outer[0] in "NS"):
            return None                               # halves cut the same way only
        strip = one_part(outer, WHOLE, 4)             # two rows or two columns
        return frozenset((r, c) for r, c in strip if SIDES[inner[0]](r % 2, c % 2, 2))
    return one_part(inner, one_part(outer, WHOLE, 4), 2)


class Scanner:
    """Reads 'NE/4 S6', 'N/2 NE/4 S6' and '1N,2E' at a place of a text, in any case."""

    def __init__(self, text):
        self.text, self.upper = text, text.upper()

    def blanks(self, i):
        while i < len(self.text) and self.text[i].isspace():
            i += 1
        return i

    def digits(self, i, most=None):
        j = i
        while j < len(self.text) and self.text[j].isdigit() and (most is None or j - i < most):
            j += 1
        return j if j > i else None

    def part(self, i):
        u = self.upper
        if u[i:i + 1] in tuple("NS") and u[i + 1:i + 2] in tuple("EW") and u[i + 2:i + 4] == "/4":
            return i + 4
        return i + 3 if u[i:i + 1] in tuple("NSEW") and u[i + 1:i + 3] == "/2" else None

    def phrase(self, i):
        first = self.part(i)
        if first is None:
            return None
        ends = [first]
        second = self.part(self.blanks(first))
        if second is not None:
            ends.insert(0, second)
        for end in ends:
            s = self.blanks(end)
            if self.upper[s:s + 1] == "S":
                end = self.digits(s + 1, 2)
                if end:
                    return end
        return None

    def grid(self, i):
        a = self.digits(i)
        if a is None or self.upper[a:a + 1] not in tuple("NS"):
            return None
        comma = self.blanks(a + 1)
        if self.text[comma:comma + 1] != ",":
            return None
        b = self.digits(self.blanks(comma + 1))
        return b + 1 if b and self.upper[b:b + 1] in tuple("EW") else None

    def tokens(self):
        """(text, is a township/range) of each phrase, left to right."""
        i = 0
        while i < len(self.text):
            for read, is_grid in ((self.phrase, False), (self.grid, True)):
                end = read(i)
                if end:
                    yield self.text[i:end], is_grid
                    i = end
                    break
            else:
                i += 1


def qualifier(token):
    """('1N', '2E') of an upper-case '1N,2E'; of '12E' only the last digit counts."""
    digits = "0123456789"
    n = len(token) - len(token.lstrip(digits))
    if token[n] not in "NS" or token[-1] not in "EW":
        return None
    return token[:n + 1], token[-2:]


def split_section(token):
    """('NE/4', 'S6') of an upper-case phrase, else None."""
    head = token.rstrip("0123456789")
    if head == token or not head.endswith("S"):
        return None
    part = head[:-1].rstrip()
    return (part, token[len(head) - 1:]) if part[-1:] in ("2", "4") else None


def label(number, above, below):
    if number is None or not -99 <= number <= 98:
        return None
    return f"{number + 1}{above}" if number >= 0 else f"{-number}{below}"


def parse(descriptions, trs):
    """descriptions {map: text}, trs [(map, tshp, rng, sec, subsec)] -> {(map, token index): status}."""
    places, has_bits = defaultdict(list), set()
    listed = set()
    for m, t, r, s, sub in trs:
        listed.add(m)
        if sub is not None:
            has_bits.add(m)
        town, rng = label(t, "N", "S"), label(r, "E", "W")
        if town and rng and s is not None:
            places[m, f"S{s}"].append(((t, r), (town, rng)))
    out = {}
    for m, text in descriptions.items():
        tokens = list(Scanner(text).tokens()) if m in listed and m not in has_bits else []
        if all(is_grid for _, is_grid in tokens):
            continue
        # The group of a token is the number of township/range tokens before it.
        group = [sum(is_grid for _, is_grid in tokens[:i]) for i in range(len(tokens))] if len(tokens) < 500 else running(tokens)
        members = defaultdict(list)
        for i, g in enumerate(group):
            members[g].append(i)
        for indexes in members.values():
            last, is_grid = tokens[indexes[-1]]
            fixed = qualifier(last) if is_grid else None
            for i in indexes[:-1] if fixed else indexes:
                out[m, i], fixed = judge(tokens[i][0], fixed, places, m)
    return out


def running(tokens):
    seen, out = 0, []
    for _, is_grid in tokens:
        out.append(seen)
        seen += is_grid
    return out


def judge(token, fixed, places, m):
    """(status, township and range that hold for the rest of the group)."""
    cut = split_section(token)
    if cut is None:
        return "bad_section", fixed
    if region(cut[0]) is None:
        return "bad_subsec", fixed
    found = [name for _, name in sorted(places[m, cut[1]])]
    if fixed:
        return ("accepted" if fixed in found else "not_in_trs"), fixed
    if not found:
        return "not_found", None
    return ("accepted" if len(found) == 1 else "ambiguous"), found[-1]
