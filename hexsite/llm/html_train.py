"""Trains the block labeller on generated pages: ``python -m hexsite.llm.html_train`` writes its weights.

Pages are drawn from a seed: invented prose of several languages in articles of many layouts (semantic elements, named
or nameless containers, tables, bare bodies), among menus, headers, footers, sidebars, notices, adverts, forms and
reader comments, each in several markups and at several places. Each block's label is known where it is drawn.
"""

from __future__ import annotations

import numpy as np

from hexsite.llm.html import HIDDEN, INPUTS, WEIGHTS, Hasher, Labeller, blocks_of, sigmoid, vectors

SYLLABLES = {
    "en": "the of and to in that is for on with as at by from this th er on an re he nd ha es ou st ed it or ti en at ing tion ble ly sh wh",
    "de": "der die und in zu den das nicht von sie ist des mit dem ein eine ch en er ie ge be te un ver sch keit ung lich heit ß ü ö ä tz pf",
    "fr": "le la les de des du et un une que qui en pour dans par sur es re ou an ent ai eau eux ment tion elle é è ê ç oi vi pa",
    "es": "el la los de que y en un una por con para del se las os ar ción ado ez ie ue rr ll ñ á í ó ga ja bo do ci",
}
NAVIGATION = "Home About Contact Products Services News Blog Shop Login Search Sitemap Archive Start Über Kontakt Produkte Impressum Datenschutz Anmelden Accueil Contactez Boutique Connexion Actualités Inicio Contacto Tienda Noticias Acerca Sports Politics World Culture Help FAQ Careers Press".split()
NOTICES = ["We use cookies to improve your experience.", "Accept all cookies", "Subscribe to our newsletter", "Sign up for free", "This site uses cookies. Read our privacy policy.", "Wir verwenden Cookies.", "Nous utilisons des cookies.", "Utilizamos cookies.", "Please enable JavaScript.", "You are reading a preview."]
FOOTS = ["© 2024 Example Inc. All rights reserved.", "Copyright 2023", "Terms of use | Privacy policy", "Alle Rechte vorbehalten.", "Tous droits réservés.", "Todos los derechos reservados.", "Powered by Example CMS", "Imprint"]
FORMS = ["Name", "E-mail", "Your message", "Send", "Search", "Password", "Log in", "Subscribe", "Submit", "Remember me"]
SIDES = ["Related articles", "Most read", "Popular posts", "Tags", "Follow us", "Latest news", "Mehr zum Thema", "À lire aussi", "Lo más leído", "Recent comments"]
TALK = ["Comments", "Reply", "Leave a comment", "Great article!", "I don't agree.", "Thanks for sharing", "Kommentare", "Commentaires", "Comentarios", "Report", "3 days ago"]


class Page:
    """One generated page: pieces of markup, each text of which is main text or not."""

    def __init__(self, draw: np.random.Generator):
        self.draw, self.out, self.labels = draw, [], []
        self.lang = str(draw.choice(list(SYLLABLES)))

    def one(self, *options):
        return options[int(self.draw.integers(len(options)))]

    def chance(self, p: float) -> bool:
        return bool(self.draw.random() < p)

    def word(self, lang: str) -> str:
        parts = SYLLABLES[lang].split()
        return "".join(parts[int(i)] for i in self.draw.integers(0, len(parts), int(self.draw.choice([1, 1, 2, 2, 3, 4]))))

    def prose(self, words: int, lang: str | None = None) -> str:
        lang = lang or self.lang
        out, start = [], True
        for _ in range(max(1, words)):
            w = self.word(lang)
            out.append(w.capitalize() if start else w)
            start = self.chance(0.12)
            if start:
                out[-1] += "."
            elif self.chance(0.08):
                out[-1] += self.one(",", ";", " &amp;", "!!", "###", ":", " |", "%%%", "***")
        return " ".join(out) + self.one(".", ".", ".", "", "!", "?")

    def put(self, markup: str, *texts: bool) -> None:
        """Markup whose blocks have these labels, in order."""
        self.out.append(markup)
        self.labels += texts

    def open(self, tag: str, *names: str) -> str:
        kind = self.one("class", "class", "id")
        name = self.one(*names) if names and self.chance(0.8) else ""
        if name and self.chance(0.3):
            name = f"{name}{self.one('-', ' ', '_')}{self.one('wrap', 'box', 'inner', 'main', 'block', 'area')}"
        self.out.append(f'<{tag} {kind}="{name}">' if name else f"<{tag}>")
        return f"</{tag}>"

    # --- what isn't main text

    def menu(self) -> None:
        end = self.open(self.one("nav", "nav", "div", "ul"), "menu", "nav", "navbar", "navigation", "breadcrumb", "topbar", "links")
        items = [self.one(*NAVIGATION) if self.chance(0.5) else self.word(self.one(*SYLLABLES)).capitalize() + self.one("", "", ",", ".") for _ in range(int(self.draw.integers(3, 10)))]
        if self.chance(0.75):
            inner = "" if end == "</ul>" else "<ul>"
            self.put(inner + "".join(f'<li><a href="/{x}">{x}</a></li>' for x in items) + inner.replace("<", "</"), *[False] * len(items))
        else:
            self.put(self.one(" | ", " ", " » ").join(f'<a href="/{x}">{x}</a>' for x in items), False)
        self.out.append(end)

    def advert(self) -> None:
        end = self.open(self.one("div", "div", "aside", "section", "ins"), "ad", "ads", "advert", "advertisement", "banner", "sponsored", "promo", "ad-slot")
        for _ in range(int(self.draw.integers(1, 3))):
            text = self.prose(int(self.draw.integers(2, 25)), self.one(*SYLLABLES))
            self.put(self.one(f"<p>{text}</p>", f"<div>{text}</div>", f'<div><a href="#">{text}</a></div>'), False)
        self.out.append(end)
        if end == "</ins>":
            self.out.append("<div></div>")

    def advert_plain(self) -> None:
        name = self.one("ad", "ad", "ads", "advert", "banner", "sponsored", "promo")
        self.put(f'<!-- ad --><div class="{name}">{self.prose(int(self.draw.integers(3, 25)), self.one(*SYLLABLES))}</div>', False)

    def notice(self) -> None:
        end = self.open(self.one("div", "section", "aside", "dialog"), "cookie", "notice", "consent", "alert", "newsletter", "popup", "message", "warning", "gdpr")
        n = int(self.draw.integers(1, 3))
        self.put("".join(f"<{t}>{self.one(*NOTICES) if self.chance(0.7) else self.prose(int(self.draw.integers(4, 20)))}</{t}>" for t in [self.one("p", "div", "button") for _ in range(n)]), *[False] * n)
        self.out.append(end)

    def form(self) -> None:
        end = self.open("form", "search", "login", "contact", "subscribe")
        n = int(self.draw.integers(1, 4))
        self.put("".join(f"<{t}>{self.one(*FORMS) if self.chance(0.7) else self.prose(int(self.draw.integers(1, 8)))}</{t}><input>" for t in [self.one("label", "div", "p") for _ in range(n)]) + f"<button>{self.one(*FORMS)}</button>", *[False] * (n + 1))
        self.out.append(end)

    def side(self) -> None:
        end = self.open(self.one("aside", "aside", "div", "section"), "sidebar", "related", "side", "widget", "recommended", "popular", "share", "social")
        title = self.one(*SIDES) if self.chance(0.7) else self.prose(2)
        self.put(f"<{(h := self.one('h2', 'h3', 'h4', 'div'))}>{title}</{h}>", False)
        n = int(self.draw.integers(1, 7))
        if self.chance(0.6):
            self.put("<ul>" + "".join(f'<li><a href="#">{self.prose(int(self.draw.integers(2, 9)))}</a></li>' for _ in range(n)) + "</ul>", *[False] * n)
        else:
            self.put("".join(f"<p>{self.prose(int(self.draw.integers(3, 30)))}</p>" for _ in range(n)), *[False] * n)
        self.out.append(end)

    def talk(self) -> None:
        end = self.open(self.one("section", "div", "div", "aside"), "comments", "comment-list", "discussion", "responses", "replies", "reader-comments")
        if self.chance(0.7):
            self.put(f"<{(h := self.one('h2', 'h3', 'div'))}>{self.one(*TALK) if self.chance(0.7) else self.prose(2)}</{h}>", False)
        for _ in range(int(self.draw.integers(1, 6))):
            inner = self.open(self.one("div", "li", "article", "div"), "comment", "reply", "response", "comment-body")
            if self.chance(0.6):
                self.put(f"<{(t := self.one('div', 'h4', 'p'))}>{self.word(self.lang).capitalize()}{self.one('', ', 3 days ago', ' wrote:', ' 2024-01-02')}</{t}>", False)
            n = int(self.draw.integers(1, 3))
            self.put("".join(f"<p>{self.one(*TALK) if self.chance(0.15) else self.prose(int(self.draw.integers(3, 45)))}</p>" for _ in range(n)), *[False] * n)
            self.out.append(inner)
        self.out.append(end)

    def head(self) -> None:
        end = self.open(self.one("header", "header", "div"), "header", "masthead", "site-header", "top", "logo")
        self.put(f"<{(h := self.one('h1', 'div', 'p', 'a', 'h2'))}>{self.prose(int(self.draw.integers(1, 4)))}</{h}>", False)
        if self.chance(0.4):
            self.put(f"<p>{self.prose(int(self.draw.integers(3, 9)))}</p>", False)
        if self.chance(0.5):
            self.menu()
        self.out.append(end)

    def foot(self) -> None:
        end = self.open(self.one("footer", "footer", "footer", "div"), "footer", "bottom", "site-footer", "copyright", "colophon")
        if self.chance(0.35):
            self.menu()
        n = int(self.draw.integers(1, 4))
        if self.chance(0.5):
            self.put(self.prose(int(self.draw.integers(3, 25)), self.one(*SYLLABLES)) if self.chance(0.6) else self.one(*FOOTS), False)
            self.out.append("<div></div>")
        else:
            self.put("".join(f"<p>{self.one(*FOOTS) if self.chance(0.5) else self.prose(int(self.draw.integers(3, 20)))}</p>" for _ in range(n)), *[False] * n)
        self.out.append(end)

    # --- main text

    def odd(self, words: int) -> str:
        """Lines of an article that look like something else."""
        some = [self.word(self.lang) for _ in range(max(2, words))]
        return self.one(
            " | ".join(some) + self.one(" |", ".", ""),
            "!! ".join(w.upper() for w in some) + "!!",
            self.one("Released under the MIT License.", "Licensed under the Apache License, Version 2.0", "All rights reserved.", "Copyright (c) 2021 the authors."),
            f'{some[0]}: {self.draw.integers(10**6, 10**9)} {some[1]}@{self.word("en")}.com',
            f'{some[0]} = "{self.draw.bytes(16).hex()}"',
            " ".join([self.prose(3)] * min(9, len(some))),
            f"{some[0]} +{self.draw.integers(10, 99)} {self.draw.integers(100, 999)} {self.draw.integers(1000, 9999)}",
        )

    def formula(self) -> str:
        """What stands in a sentence and isn't a word: formulas, drawings and fallback contents."""
        x = self.word("en")
        return self.one(f"<math><mi>{x}</mi><mo>=</mo><mn>5</mn></math>", f"<svg><text>{x}</text></svg>", f"<object>{self.prose(3)}</object>", f"<noscript>{self.prose(2)}</noscript>", f"<code>{x}()</code>", f"<sup>{x}</sup>")

    def lines(self) -> None:
        """Very many short paragraphs: a poem, a talk, a list of names."""
        most = int(self.draw.integers(1, 5))
        tag = self.one("p", "p", "p", "div", "li")
        n = int(self.draw.choice([10, 30, 80, 200]))
        self.put("".join(f"<{tag}>{self.prose(int(self.draw.integers(1, most + 1))) if self.chance(0.7) else self.word(self.lang)}</{tag}>" for _ in range(n)), *[True] * n)

    def paragraph(self) -> None:
        words = int(self.draw.choice([1, 2, 4, 8, 15, 30, 60, 100, 160]))
        text = self.prose(words) if self.chance(0.85) else self.odd(words)
        self.put(self.one(f"<p>{text}</p>", f"<p>{text}</p>", f"<p>{text}</p>", f"<p>{text}", f"<p><b>{text}<br>", f'<p>{text} <a href="#">{self.prose(3)}</a> {self.prose(4)}</p>', f"<p><em>{self.prose(2)}</em> {text}</p>", f"<p>{text}<br>{self.prose(6)}</p>", f"<p>{self.prose(2)} {self.formula()} {text}</p>"), True)

    def article(self, bare: bool) -> None:
        if bare:
            end = ""
        else:
            tag = self.one("article", "article", "article", "main", "div", "div", "section", "td")
            end = self.open(tag, "article", "post", "content", "entry", "story", "main", "text", "body", "article-body", "post-content")
            if tag == "td":
                self.out[-1] = "<table><tr>" + self.out[-1]
                end += "</tr></table>"
        if self.chance(0.8):
            self.put(f"<{(h := self.one('h1', 'h1', 'h2'))}>{self.prose(int(self.draw.integers(1, 14)))}</{h}>", True)
        loose = not bare and self.chance(0.12)
        if not bare and self.chance(0.06):
            self.lines()
        for _ in range(int(self.draw.choice([1, 2, 3, 5, 8, 12, 20, 35]))):
            kind = self.draw.random()
            if loose:
                self.put(f"<div>{self.prose(int(self.draw.integers(5, 90)))}</div>", True)
            elif kind < 0.82:
                self.paragraph()
            elif kind < 0.87:
                self.put(f"<{(h := self.one('h2', 'h3'))}>{self.prose(int(self.draw.integers(1, 9)))}</{h}>", True)
            elif kind < 0.92:
                n = int(self.draw.integers(2, 6))
                self.put("<ul>" + "".join(f"<li>{self.prose(int(self.draw.integers(1, 25)))}</li>" for _ in range(n)) + "</ul>", *[True] * n)
            elif kind < 0.95:
                self.put(f"<blockquote>{self.prose(int(self.draw.integers(5, 40)))}</blockquote>", True)
            elif kind < 0.96 and not end.startswith("</td"):
                n = int(self.draw.integers(2, 7))
                self.put("<table><tr>" + "".join(f"<td>{self.prose(int(self.draw.integers(1, 5)))}</td>" for _ in range(n)) + "</tr></table>", *[True] * n)
            elif kind < 0.97:
                self.put(f"<pre>{self.prose(int(self.draw.integers(3, 20)))}</pre>", True)
            elif kind < 0.98:
                self.advert_plain()
            elif kind < 0.985:
                self.notice()
            elif kind < 0.99:
                self.side()
            else:
                self.paragraph()
        if not bare and self.chance(0.06):
            self.talk()
        self.out.append(end)

    def make(self) -> tuple[str, list[bool]]:
        self.out.append(f'<!DOCTYPE html><html lang="{self.lang}"><head><meta charset="utf-8"><title>{self.prose(4)}</title><style>p{{margin:0}}</style><script>var t="</p>";</script></head><body>')
        wrap = self.open("div", "wrapper", "page", "container", "site") if self.chance(0.4) else ""
        for f, p in ((self.head, 0.4), (self.menu, 0.7), (self.notice, 0.2), (self.advert_plain, 0.4), (self.advert, 0.2), (self.form, 0.15), (self.side, 0.12)):
            if self.chance(p):
                f()
        bare = self.chance(0.06)
        self.article(bare)
        after = [(self.advert_plain, 0.25), (self.advert, 0.2), (self.side, 0.35), (self.talk, 0.35), (self.form, 0.25), (self.notice, 0.2), (self.menu, 0.12)]
        self.draw.shuffle(after)
        for f, p in after:
            if self.chance(p):
                f()
        if self.chance(0.8):
            self.foot()
        self.out.append(wrap + "</body></html>")
        return "".join(self.out), self.labels


def pages(n: int, seed: int) -> list[tuple[str, list[bool]]]:
    draw = np.random.default_rng(seed)
    return [Page(draw).make() for _ in range(n)]


def begin(seed: int) -> dict[str, np.ndarray]:
    draw = np.random.default_rng(seed)
    w = {}
    for side in "fb":
        w[side + "x"] = draw.normal(0, 0.15, (INPUTS, 4 * HIDDEN))
        w[side + "h"] = draw.normal(0, 0.15, (HIDDEN, 4 * HIDDEN))
        w[side + "b"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
    return w | {"of": draw.normal(0, 0.2, HIDDEN), "ob": draw.normal(0, 0.2, HIDDEN), "o": np.zeros(1)}


def gradients(w: dict[str, np.ndarray], x: np.ndarray, mask: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Loss and gradients of one batch, by back-propagation through time in both directions."""
    steps, n, _ = x.shape
    keep, hidden = {}, {}
    for side, xs, ms in (("f", x, mask), ("b", x[::-1], mask[::-1])):
        h = c = np.zeros((n, HIDDEN), np.float32)
        trace = []
        gates = (xs.reshape(-1, INPUTS) @ w[side + "x"] + w[side + "b"]).reshape(steps, n, -1)
        hs = np.empty((steps, n, HIDDEN), np.float32)
        for t in range(steps):
            g = gates[t] + h @ w[side + "h"]
            s, u = sigmoid(g[:, : 3 * HIDDEN]), np.tanh(g[:, 3 * HIDDEN :])
            new = s[:, HIDDEN : 2 * HIDDEN] * c + s[:, :HIDDEN] * u
            th = np.tanh(new)
            m = ms[t][:, None]
            trace.append((h, c, s, u, th, m))
            c, h = np.where(m, new, c), np.where(m, s[:, 2 * HIDDEN :] * th, h)
            hs[t] = h
        keep[side], hidden[side] = trace, hs
    ahead, back = hidden["f"], hidden["b"][::-1]
    p = sigmoid(ahead @ w["of"] + back @ w["ob"] + w["o"])
    total = max(1, mask.sum())
    loss = -float((np.log(np.where(label, p, 1 - p) + 1e-7) * mask).sum() / total)
    d = ((p - label) * mask / total).astype(np.float32)
    out = {"of": np.einsum("tn,tnh->h", d, ahead), "ob": np.einsum("tn,tnh->h", d, back), "o": d.sum(keepdims=True).reshape(1)}
    for side, xs, top in (("f", x, d), ("b", x[::-1], d[::-1])):
        dh_next = dc_next = np.zeros((n, HIDDEN), np.float32)
        dg_all = np.empty((steps, n, 4 * HIDDEN), np.float32)
        wo, wh = w["o" + side], w[side + "h"]
        dwh = np.zeros_like(wh)
        for t in range(steps - 1, -1, -1):
            h0, c0, s, u, th, m = keep[side][t]
            dh = dh_next + top[t][:, None] * wo
            i, f, o = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :]
            dm = np.where(m, dh, 0)
            dc = np.where(m, dc_next, 0) + dm * o * (1 - th * th)
            dg = np.concatenate([dc * u * i * (1 - i), dc * c0 * f * (1 - f), dm * th * o * (1 - o), dc * i * (1 - u * u)], axis=1)
            dg_all[t] = dg
            dwh += h0.T @ dg
            dh_next = dg @ wh.T + np.where(m, 0, dh)
            dc_next = dc * f + np.where(m, 0, dc_next)
        flat = dg_all.reshape(-1, 4 * HIDDEN)
        out |= {side + "x": xs.reshape(-1, INPUTS).T @ flat, side + "h": dwh, side + "b": flat.sum(axis=0)}
    return loss, out


def train(n: int = 5000, rounds: int = 5, batch: int = 40, seed: int = 10, say=lambda *_: None) -> dict[str, np.ndarray]:
    hasher = Hasher()
    made = []
    for page, labels in pages(n, seed):
        found = blocks_of(page)
        if len(found) == len(labels):  # a drawn text may vanish or merge; such a page isn't used
            made.append((vectors(found, hasher), np.array(labels, np.float32)))
    say(f"{len(made)} of {n} pages, {sum(len(y) for _, y in made)} blocks")
    w = {k: v.astype(np.float32) for k, v in begin(seed).items()}
    first, second, step = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}, 0
    draw = np.random.default_rng(seed)
    made.sort(key=lambda p: len(p[1]))
    for r in range(rounds):
        starts = list(range(0, len(made), batch))
        draw.shuffle(starts)
        losses = []
        for s in starts:
            some = made[s : s + batch]
            steps = max(len(y) for _, y in some)
            x, mask, label = np.zeros((steps, len(some), INPUTS), np.float32), np.zeros((steps, len(some)), bool), np.zeros((steps, len(some)), np.float32)
            for k, (v, y) in enumerate(some):
                x[: len(y), k], mask[: len(y), k], label[: len(y), k] = v, True, y
            # names and words are dropped at random, so that no one of them decides
            x[:, :, : INPUTS - 8] *= draw.random((1, len(some), INPUTS - 8)) > 0.15
            loss, g = gradients(w, x, mask, label)
            losses.append(loss)
            size = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
            step += 1
            rate = 0.004 * (1 - (r + len(losses) / len(starts)) / rounds * 0.9)
            for k, v in g.items():
                v = v * min(1.0, 2.0 / max(size, 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * v
                second[k] = 0.999 * second[k] + 0.001 * v * v
                w[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        say(f"round {r}: loss {np.mean(losses):.4f}")
    return w


def accuracy(w: dict[str, np.ndarray], n: int = 400, seed: int = 99) -> float:
    """Share of right labels on pages of another seed."""
    hasher, labeller = Hasher(), Labeller(w)
    some = [(blocks_of(p), y) for p, y in pages(n, seed)]
    some = [(b, y) for b, y in some if len(b) == len(y)]
    found = labeller.label([vectors(b, hasher) for b, _ in some])
    return float(np.mean(np.concatenate([f == np.array(y) for f, (_, y) in zip(found, some, strict=True)])))


if __name__ == "__main__":
    trained = train(say=print)
    np.savez_compressed(WEIGHTS, **{k: v.astype(np.float16) for k, v in trained.items()})
    print("held-out accuracy", accuracy(trained))
