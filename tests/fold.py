"""A plain state machine for the structuring rules, written from their table; only for tests."""

import re

from lexstrata.functions import patterns as P


def _re(java):
    flags = 0
    if m := re.match(r"\(\?([a-zU]+)\)", java):
        java = java[m.end() :]
        flags |= re.I if "i" in m[1] else 0
        flags |= re.S if "s" in m[1] else 0
    return re.compile(java, flags)


class Fold:
    def __init__(self, p=P.COMPAT):
        names = ("article", "article_split", "ordinal_article", "transitory", "transitory_ordinal", "part", "prose", "connector", "roman", "clause", "name")
        self.re = {n: _re(getattr(p, n)) for n in names}
        self.out, self.open, self.transitory, self.name_due = [], "", False, False

    def flush(self, *then):
        if self.open:
            self.out.append(self.open)
            self.open = ""
        self.out.extend(then)

    def roman(self, s):
        m = self.re["roman"].match(s)
        return bool(m) and re.fullmatch("(?:XL|L?X{0,3})(?:IX|IV|V?I{0,3})", m[1]) is not None and m[1] != ""

    def part(self, s):
        m = self.re["part"].match(s)
        return m if m and not (m[2].strip() and self.re["prose"].match(m[2].strip())) else None

    def is_name(self, s):
        if len(s) > 100 or re.match(r"\d", s) or self.part(s) or self.roman(s) or any(self.re[k].match(s) for k in ("article", "ordinal_article", "transitory")):
            return False
        caps = s == s.upper() and re.search("[A-ZÁÉÍÓÚÑ]{3,}", s)
        return bool(caps or (self.re["name"].match(s) and len(s) < 80))

    def feed(self, line):
        s, due = line.strip(), self.name_due
        self.name_due = False
        if not s:
            return self.flush("")
        if s[0] == ">":
            return self.flush("", s, "")
        if s[0] == "|":
            return self.flush(s)
        if due and self.is_name(s):
            self.out[-1] += " — " + s
            return None
        if m := self.re["transitory"].match(s):
            self.flush("", "## " + m[1], "")
            self.transitory = True
            s = s[len(m[1]) :].strip()
            if not s:
                return None
        return self.body(s)

    def body(self, s):
        article = self.re["ordinal_article"].match(s)
        numbered = None if article else self.re["article"].match(s)
        if article or numbered:
            if self.open and self.re["connector"].search(self.open):
                self.open += " " + s
                return
            m = article or self.re["article_split"].match(s)
            rest = m[2].strip()
            self.flush("", "### " + m[1].strip().rstrip("."))
            if numbered:
                self.transitory = False
            self.open = rest.lstrip(".-").strip() if article else rest
            return
        if m := self.part(s):
            rest = m[2].strip()
            self.flush("", "## " + m[1].strip() + (" — " + rest if rest else ""))
            self.name_due = not rest
            return
        m = self.re["transitory_ordinal"].match(s) if self.transitory else None
        if m:
            self.flush()
            rest = m[2].strip().lstrip(".-").strip()
            mark = ".-" if ".-" in s[: len(m[1]) + 3] else "."
            self.open = f"**{m[1].strip()}{mark}**" + (" " + rest if rest else "")
        elif self.roman(s) or self.re["clause"].match(s):
            self.flush(*([""] if self.open else []))
            self.open = s
        elif self.open.endswith("-"):
            self.open = self.open[:-1] + s
        elif self.open and self.open[-1] in ".;:" and s[0].isupper():
            self.flush()
            self.open = s
        else:
            self.open = f"{self.open} {s}" if self.open else s

    def result(self):
        self.flush()
        final = []
        for line in self.out:
            if not line or line.startswith(("#", ">", "---", "**")):
                final.append(line)
                continue
            for i, part in enumerate(re.split(r"(?<=[.:])\s+(?=[a-z]\)\s)", line)):
                final += ([""] if i else []) + [part.strip()]
        return final


def without_running_header(lines):
    caps = [" ".join(x.split()) for x in lines if len(x.strip()) > 15 and x.strip() == x.strip().upper() and re.search("[A-ZÁÉÍÓÚÑ]{4,}", x)]
    header = max(dict.fromkeys(caps), key=caps.count, default=None)
    if caps.count(header) < 3:
        return lines
    return [(x.strip().replace(header, " ").strip() if header in x.strip() else x.strip()) for x in lines if " ".join(x.split()) != header]


def fold(lines):
    f = Fold()
    for x in without_running_header(lines):
        f.feed(x)
    return f.result()
