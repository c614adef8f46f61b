"""Labelled pages for fitting and testing the page model, from a rule: random layouts, wordings and markings.

Elements carry data-y: 1 for content and what holds content, 0 for the rest; without it an element is as its parent.
"""

from __future__ import annotations

import random

SYLLABLES = "an ba cor de el fi gan ha in jo ka lu men no or pa qui ra sen ti un ver wa xe yo za ér ß ün ño".split()


class Page:
    def __init__(self, rng: random.Random):
        self.r = rng
        self.semantic = rng.random() < 0.6
        self.marked = rng.random() < 0.75 or not self.semantic

    def word(self) -> str:
        return "".join(self.r.choice(SYLLABLES) for _ in range(self.r.randint(1, 4)))

    def phrase(self, a: int, b: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(a, b))).capitalize()

    def prose(self, a: int, b: int) -> str:
        out = []
        for _ in range(self.r.randint(a, b)):
            out.append(self.phrase(1, 14) + self.r.choice((".", ".", ".", "!", "?", ", " + self.word() + ".")))
        text = " ".join(out)
        if self.r.random() < 0.2:
            text = text.replace(" ", f' <a href="/{self.word()}">{self.word()}</a> ', 1)
        if self.r.random() < 0.15:
            text = f"<b>{text}" if self.r.random() < 0.5 else f"<em>{text}</em>"
        return text

    def tag(self, name: str, mark: str, inner: str, y: int | None = None) -> str:
        name = name if self.semantic or name in ("p", "ul", "form") else "div"
        label = "" if y is None else f' data-y="{y}"'
        use = mark and (self.marked or name == "div") and self.r.random() < 0.9
        suffix = self.r.choice(("", "", "-wrap", " box", f" {self.word()}", f"-{self.r.randint(1, 99)}"))
        attr = f' {self.r.choice(("class", "class", "id"))}="{mark}{suffix}"' if use else ""
        return f"<{name}{label}{attr}>{inner}</{name}>"

    def links(self, n: int) -> str:
        items = [f'<a href="/{self.word()}">{self.phrase(1, 3)}</a>' for _ in range(n)]
        return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>" if self.r.random() < 0.7 else self.r.choice((" ", " | ", "")).join(items)

    def nav(self) -> str:
        return self.tag("nav", self.r.choice(("nav", "menu", "navbar", "main-menu", "breadcrumb")), self.links(self.r.randint(2, 9)), 0)

    def header(self) -> str:
        inner = self.r.choice((f"<h1>{self.phrase(1, 3)}</h1>", f"<p>{self.phrase(2, 8)}</p>", f'<a href="/">{self.phrase(1, 2)}</a>', f"<div>{self.prose(1, 2)}</div>"))
        return self.tag("header", self.r.choice(("header", "masthead", "topbar", "site-header")), inner + (self.links(3) if self.r.random() < 0.4 else ""), 0)

    def ad(self) -> str:
        return self.tag(self.r.choice(("div", "aside", "section", "div")), self.r.choice(("ad", "ads", "advert", "sponsored", "promo", "ad-slot")), self.r.choice((self.prose(1, 4), f"<p>{self.prose(1, 3)}</p>", f'<a href="/x">{self.phrase(3, 9)}</a>')), 0)

    def notice(self) -> str:
        return self.tag(self.r.choice(("div", "section", "aside", "p")), self.r.choice(("cookie-notice", "notice", "consent", "popup", "newsletter", "alert", "gdpr")), self.r.choice((self.prose(1, 4), f"<p>{self.prose(1, 3)}</p>", f"<p>{self.prose(1, 2)}</p><button>{self.phrase(1, 2)}</button>")), 0)

    def side(self) -> str:
        return self.tag("aside", self.r.choice(("sidebar", "side", "widget", "related", "right-rail")), f"<h{self.r.randint(2, 4)}>{self.phrase(1, 4)}</h{self.r.randint(2, 4)}>" * self.r.randint(0, 1) + self.r.choice((self.links(5), f"<p>{self.prose(1, 3)}</p>", f"<p>{self.prose(1, 2)}</p><p>{self.prose(1, 2)}</p>")), 0)

    def form(self) -> str:
        return self.tag("form", self.r.choice(("search", "login", "contact", "")), f'<label>{self.phrase(1, 5)}</label><input type="text"><p>{self.prose(0, 1)}</p><button>{self.phrase(1, 2)}</button>', 0)

    def comments(self) -> str:
        one = lambda: self.tag(self.r.choice(("div", "article", "li", "p")), self.r.choice(("comment", "reply", "comment-body")), self.r.choice(("", f"<b>{self.word()}</b>: ")) + self.r.choice((f"<p>{self.prose(1, 4)}</p>", self.prose(1, 5))), 0)
        return self.tag("section", self.r.choice(("comments", "responses", "discussion", "comment-list")), f"<h3>{self.phrase(1, 3)}</h3>" * self.r.randint(0, 1) + "".join(one() for _ in range(self.r.randint(1, 5))), 0)

    def footer(self) -> str:
        return self.tag("footer", self.r.choice(("footer", "site-footer", "copyright", "legal")), self.r.choice(("", "&copy; ")) + self.r.choice((self.prose(1, 4), f"<p>{self.prose(1, 3)}</p>", self.links(4), f"{self.word()}.example &middot; {self.prose(2, 4)}")), 0)

    def article(self) -> str:
        out = [f"<h1>{self.phrase(2, 9)}</h1>"] if self.r.random() < 0.85 else []
        for _ in range(self.r.choice((1, 1, 2, 3, 5, 8, 14))):
            kind = self.r.random()
            if kind < 0.7:
                out.append(f"<p>{self.prose(0 if self.r.random() < 0.1 else 1, 8)}" + self.r.choice(("</p>", "</p>", "</p>", "", "<br>")))
            elif kind < 0.78:
                n = self.r.randint(2, 4)
                out.append(f"<h{n}>{self.phrase(1, 7)}</h{n}>")
            elif kind < 0.84:
                out.append("<ul>" + "".join(f"<li>{self.prose(1, 2)}</li>" for _ in range(self.r.randint(2, 5))) + "</ul>")
            elif kind < 0.88:
                out.append(f"<blockquote>{self.r.choice(('', '<p>'))}{self.prose(1, 3)}</blockquote>")
            elif kind < 0.91:
                out.append("<table><tr>" + "".join(f"<td>{self.phrase(1, 4)}</td>" for _ in range(3)) + "</tr></table>")
            elif kind < 0.94:
                out.append(f"<pre>{self.phrase(3, 20)}</pre>")
            elif kind < 0.97:
                out.append(f"<div>{self.prose(1, 5)}</div>")
            else:
                out.append(f"<figure><figcaption>{self.prose(1, 1)}</figcaption></figure>")
        for part in (self.ad, self.notice, self.comments, self.side, self.form):
            if self.r.random() < 0.12:
                out.insert(self.r.randint(1 if len(out) > 1 else 0, len(out)), part())
        return self.tag(self.r.choice(("article", "article", "main", "div")), self.r.choice(("article", "content", "post", "entry-content", "story", "main")), "".join(out), 1)

    def build(self) -> str:
        r = self.r
        body = [self.article()]
        if r.random() < 0.35:
            body = [f"<div{r.choice(('', ' id=page', ' class=wrap'))} data-y=\"1\">" + "".join(body + ([self.side()] if r.random() < 0.4 else [])) + "</div>"]
        before = [f() for f, p in ((self.notice, 0.25), (self.header, 0.5), (self.nav, 0.8), (self.ad, 0.5), (self.form, 0.2)) if r.random() < p]
        after = [f() for f, p in ((self.comments, 0.4), (self.side, 0.4), (self.ad, 0.3), (self.form, 0.2), (self.notice, 0.2), (self.footer, 0.8)) if r.random() < p]
        r.shuffle(before)
        return f"<!DOCTYPE html><html><head><title>{self.phrase(1, 5)}</title><style>p{{margin:0}}</style></head><body>" + "".join(before + body + after) + "</body></html>"


def labelled(n: int, seed: int = 1) -> list[str]:
    rng = random.Random(seed)
    return [Page(rng).build() for _ in range(n)]


def truth(page: str) -> str:
    """The text of the nodes labelled content."""
    import html

    from wickwork.llm.dom import parse

    nodes, blocks = parse(page)
    y = [1 if n.label is None else n.label for n in nodes]
    for i in range(1, len(nodes)):
        if nodes[i].label is None:
            y[i] = y[nodes[i].parent]
    return "\n".join(t for t in (" ".join(html.unescape(t).split()) for i, t in blocks if y[i]) if t)


if __name__ == "__main__":
    import json
    from pathlib import Path

    from wickwork.llm.dom import fit

    (Path(__file__).parent / "html_model.json").write_text(json.dumps(fit(labelled(400)), indent=0) + "\n")
