"""Made documents for training the markup labeller: blocks of plain text, of each family, of two, and of signs that only resemble markup; each block with the families it was made of."""

from __future__ import annotations

import numpy as np

_WORDS = {
    "en": "river garden window paper method teacher number market winter letter system family music bridge history table voice colour village machine report north public early strong simple carried opened found written moved between under after during every without".split(),
    "de": "Fluss Garten Fenster Papier Lehrer Zahl Markt Winter Brief Familie Musik Brücke Geschichte Tisch Stimme Farbe Dorf wurde nach über ohne jeder klein stark früh öffentlich".split(),
    "fr": "rivière jardin fenêtre papier méthode nombre marché hiver lettre famille musique pont histoire table voix couleur été avec sans chaque petit fort écrit trouvé entre".split(),
    "hi": "नदी बाग़ खिड़की काग़ज़ शिक्षक संख्या बाज़ार सर्दी परिवार संगीत पुल इतिहास मेज़ आवाज़ रंग गाँव में के बाद और से को था है".split(),
}
_REFERENCES = "amp lt gt quot apos nbsp mdash ndash hellip copy eacute ouml uuml agrave ccedil alpha beta sum euro sect deg times middot bull laquo raquo thinsp shy para trade".split()
_SOME_TAGS = "b i em strong span sub sup u p div li td h2 h3 blockquote code small tt section center pre th dd font cite q".split()
_ENVIRONMENTS = "quote center abstract align* figure proof theorem".split()


class _Maker:
    def __init__(self, r: np.random.Generator):
        self.r = r
        self.lang = self.pick(["en", "en", "en", "de", "fr", "hi"])

    def pick(self, xs):
        return xs[int(self.r.integers(len(xs)))]

    def n(self, a=1, z=99):
        return int(self.r.integers(a, z + 1))

    def word(self):
        """A word of the language, or one made up, so that no word itself tells a family."""
        if self.r.random() < 0.5:
            return self.pick(_WORDS[self.lang])
        if self.lang == "hi":
            return "".join(self.pick("कखगचजटडतदनपबमयरलवसह") + self.pick(["", "ा", "ि", "ी", "ु", "े", "ो", "ं", "्"]) for _ in range(self.n(1, 5)))
        w = "".join(self.pick("bcdfghjklmnprstvwz") + self.pick("aeiouyéöü") for _ in range(self.n(1, 4))) + self.pick(["", "n", "r", "st"])
        return self.pick([w, w, w, w.capitalize(), f"{w}-{self.pick(_WORDS[self.lang])}", f"{w}'s"])

    def words(self, a=1, z=3):
        return " ".join(self.word() for _ in range(self.n(a, z)))

    def sentence(self):
        s = self.words(5, 14)
        if self.r.random() < 0.4:
            s += " " + self.pick([f"{self.n()} {self.words()}", f"{self.n()}.{self.n()} {self.word()}", f"{self.pick('ABCEGR')}. {self.word().capitalize()}", f"{self.pick('ABR')}{self.n()}-{self.n()}/{self.pick('ABC')}", f"EUR {self.n()}.{self.n()}", f"{1800 + self.n()}-{1900 + self.n()}"])
        if self.r.random() < 0.2:
            s = s.replace(" ", self.pick([", ", "; ", ": "]), 1)
        return s[:1].upper() + s[1:] + self.pick([".", ".", ".", "।" if self.lang == "hi" else ".", ""])

    def title(self):
        return self.pick(["", "", "", f"Annex {self.pick('ABC')}: "]) + " ".join(w[:1].upper() + w[1:] for w in self.words(2, 5).split())

    def formula(self):
        a, b, k = self.pick("abcdknxyz"), self.pick("abcdknxyz"), self.n(1, 60)
        return self.pick([
            rf"\frac{{{a}}}{{{k}}}", rf"{a}^{{2}} \cdot {k}", rf"\sqrt{{{a}_{k % 9}}}", rf"\sum_{{i=1}}^{{{a}}} {b}_i", rf"\alpha_{{{a}}} \leq {k}", rf"\mathrm{{{a.upper()}}} = \frac{{{b} + {k}}}{{{a}}}", rf"\int_0^{{{k}}} {a}\,d{b}", rf"{a}_{k % 9} + {b}_{{{k}}}", rf"\lim_{{{a} \to \infty}} {b}^{k % 9}",
        ])

    # one block of each kind

    def plain(self):
        s, w, n, k = self.sentence(), self.words(1, 1), self.n(), self.n()
        return self.pick([
            s, s, f"{s} {self.sentence()}", f"({n % 9 + 1}) {s}\n({n % 9 + 2}) {self.sentence()}", f"It's {w}'s '{w}' note. {s}", f"Case #{n}; R&D {w}. {s}", f"{s} x = -{n}; |x| = {n}.", f"{s} Values of {n} < {n + k} and {n + k} > {n}.", f"{self.title()} ........ {n}", f"{s} It cost ${n} to ${n + k} per {w}.", f"{s} Size {n}*{k} cm.",
            f"{s} See {w}_{w}_v{n}.pdf.", f"{s} C:\\temp\\new_{w}\\{n}.", f'{s} "{w} [sic]".', f"{s} About ~{n} % of 2^{n % 12} (see {{{w}}}).\nName: ____________", f"{s} AT&T; {n} & {k}.", f"{s} [{n}] {w}/{w}", f"{n}. {self.title()}", f"a - b - {w}\n* {s}", f"{s} (see p. {n}; {w}: {k}) – {w}", f"{s} {w} = {n} + {k}, i.e. {n} / {k}.", f"{w} - {w}\n- {s}",
            f"{self.title()}\n\n{s}", f"Q&A; {s}", f"{s} <{n}> {w}@{w}.org #{n} {w}!", f"{s} (*) {w} * {w}; {n}_{k}.", f"{w}: {n} | {w}: {k}", f"{s} `{w}'; {w}'', `{w}", f"{s} ^{n} ~ {k} {{{n}}} [{w}] ({w})", f"{s} {w}... {w}?! {w} -- {w}", f"D:\\{w}\\{w} {s}", f"{w} | {n} | {self.word()}\n{self.word()} | {k} | {w}", self.title(), f"- {s}\n- {self.sentence()}", f"{w}:\n{s}", f"{s} * {w}: {n}.", f"\\\\{w}\\{w} {s}", f"$ {w} --{w} {n}", f"> {n} {w}: {s}",
        ])

    def html(self):
        s, t, w = self.sentence(), self.sentence(), self.words(1, 1)
        row = lambda tag: "<tr>" + "".join(f"<{tag}>{self.words(1, 2)}</{tag}>" for _ in range(self.n(2, 4))) + "</tr>"
        a = self.pick(_SOME_TAGS)
        return self.pick([
            f"<p>{s}</p>", f"<p><b>{self.title()}</b></p>", f"<h{self.n(1, 6)}>{self.title()}</h2>", f"<pre><code>{w} --x {self.n()}\n  if a &lt; 2:\n    {w}(b)</code></pre>", f"&lt;p&gt;{s}&lt;/p&gt;", f"<div class='c'><style>.a{{color:red}}</style><span>{s}</span><sup>{self.n(1, 9)}</sup></div>", f"<p>{s} <i>{t}", f"<P ALIGN=center><FONT size=2>{s}</FONT><BR>{t}",
            f"<!-- {w} -->{s}<br/>\n{t}", f"{s} &mdash; {w}&#160;{self.n()}", f"{s} &amp; {w}", f"{s} &#x2009;{self.n()}", f"<table>{row('th')}{row('td')}</table>", f"<ul><li>{s}</li><li>{t}</li></ul>", f"<td>{s} {t}", f"{s}</td><td>{t}", f"{s} &lt {t}", f"{s}<br>{t}", f"{s}</p>\n{t}", f"<ol><li>{s}</ol>", f"<a href='x'>{w}</a> {s}",
            f"{s[:-1]}&{self.pick(_REFERENCES)};{w} {t}", f"{s} &{self.pick(_REFERENCES)}; {t}", f'<div class="col">\n<p>{s}</p>\n</div>', f"<{a}>{s}</{a}> {t}", f"<!DOCTYPE html><html><body>{s}</body></html>", f"{s}<img src='a_{self.n()}.png'/>", f"{s} <{a}>{w}</{a}>.", f"&lt;{a}&gt;{s}", f"{s} {w}<{a}>{self.n()}</{a}>", f"<!-- {s} -->",
        ])

    def markdown(self):
        s, t, w = self.sentence(), self.sentence(), self.words(1, 2)
        return self.pick([
            f"{'#' * self.n(1, 6)} {self.title()}\n\n{s}", f"{self.title()}\n=======\n{s}", f"{self.title()}\n{'=' * self.n(4, 40)}\n{s}", f"{self.title()}\n-------\n\n{s}", f"{s} **{w}** {t}", f"{s} The __{w}__ is ~~{w}~~.", f"{s} Run `{w} --x {self.n()}` first.", f"{s} See [{w}](notes/{self.n()}.md).", f"{s} [{w}]({self.word()}/{self.word()}.{self.pick(['md', 'html', 'pdf'])}) {t}", f"{s} {w} [{self.title()}](https://{self.word()}.example/{self.n()}).", f"{s} See [{w}]({self.word()}.md).", f"![{self.title()}](fig_{self.n()}.png)\n{s}", f"{s}\n\n```python\nfor a in b:\n    f(a)\n```\n",
            f"{s}[^{self.n(1, 9)}]\n\n[^{self.n(1, 9)}]: {t}", f"{self.pick('-*')} [{self.pick(' xX')}] {s}\n- [{self.pick(' xX')}] {t}", f"- [{self.pick(' x')}] {s}", f"{s} An _{w}_ note.\n> {t}", f"> {s}", f"| a | b |\n|---|---|\n| {w} | {self.n()} |", f"| {w} | {w} | c |\n|---|:--|--:|\n| {w} | {self.n()} | {w} |", f"* {s}\n* **{w}** {t}", f"{s} *{w}* {t}", f"1. {s}\n2. **{w}**", f"# {self.title()}", f"{'#' * self.n(1, 3)} {self.title()}\n\n{s}", f"# {self.title()}\n{s}", f"{s} ***{w}*** {t}", f"[{w}]: https://{self.word()}.example/{self.n()}\n{s}",
            f"{s} [{w}][{self.n()}]", f"{s} <https://w{self.n()}.example/{self.n()}>", f"* {s}\n* {t}\n* {w}", f"+ {s}\n+ {t}", f"~~~\n{w} = {self.n()}\n~~~", f"{w} | {w}\n--- | ---\n{w} | {self.n()}", f"{s}\n\n***\n\n{t}", f"```\n{w} --{w}\n```\n{s}", f"{'#' * self.n(1, 6)} {self.title()}", f"1. {s}\n2. {t}\n3. `{w}`", f"{s} _{w}_ {t}", f"{s} ~~{w}~~",
        ])

    def wiki(self):
        s, t, w = self.sentence(), self.sentence(), self.words(1, 2)
        e = "=" * self.n(2, 6)
        return self.pick([
            f"{e} {self.title()} {e}\n{s}", f"{e}{self.title()}{e}\n{s}", f"{s} The '''{w}''' is ''{w}''.", f"{s} See [[{self.title()}|the {w}]] or [[{w}]].", f"[[File:p_{self.n()}.png|thumb|{self.title()}]]\n{s}", f"{{{{cite {w}|title={self.title()}|no={self.n()}}}}} {s}", f"{s} [https://w.example.invalid/{self.n()} The {w}]", f"{s}\n;{w}\n:{t}\n::''{w}''",
            f"=== {self.title()} ===\n* [[{w}]]: {s}\n** {t}\n:: {w}", f'{{| class="g"\n! {w} !! {w}\n|-\n| {self.n()} || {w}\n|}}', f"# {s}\n# [[{w}]]\n## {t}", f"* {s}\n* ''{w}''", f"{s} {{{{{w}|{self.n()}}}}}", f"{s} [[Category:{self.title()}]]", f"== {self.title()} ==", f"= {self.title()} =\n{s}", f"# {s}\n# {t}\n## ''{w}''", f"__NOTOC__\n{s}", f"{s} '''''{w}''''' {t}",
            f": {s}\n:: {t}", f"#REDIRECT [[{self.title()}]]", f"{s} ~~~~", f'{{| border="1"\n|-\n| {w}\n| {self.n()}\n|}}', f"** {s}\n*** {t}", f"{s} ''{w} {w}''", f"* [[{w}]]\n* {s}\n# {t}", f"* [[{w}]]: {s}\n* {t}", f"* {s}\n* [[{w}]] {t}", f"* '''{w}''': {s}\n* {t}\n* {w}", f";{w}\n:{s}", f"{s}\n----\n'''{w}''' {t}",
        ])

    def latex(self):
        s, t, w, f = self.sentence(), self.sentence(), self.words(1, 1), self.formula()
        return self.pick([
            f"$${f} = {self.n()}$$", f"$${f}$$ {s}", f"\\[ {f} \\]", f"{s} Let ${f}$ be given, as in~\\ref{{eq:{self.n()}}}.", f"{s} Here ${self.pick('abcdknxyz')}$ is the {w} \\ldots", f"\\begin{{tabular}}{{ll}}\n{w} & {w} \\\\\n{self.n()} & {w}\n\\end{{tabular}}", f"{s} \\textbf{{{w}}} \\emph{{{w}}}.", f"\\subsection*{{{self.title()}}}\n{s}", f"\\section{{{self.title()}}}\n{s}", f"\\item {s}\n\\item {t}",
            f"\\begin{{itemize}}\n\\item {s}\n\\item {t}\n\\end{{itemize}}", f"\\begin{{verbatim}}\n{w} {self.n()}\n\\end{{verbatim}}\n{s}", f"The {{\\bf {w}}} weighs {self.n()}\\,kg, i.e. {self.n()}\\% more.", f'{s}~\\cite{{{w}{self.n()}}} K\\"{{o}}l wrote it.', f"{s}\\footnote{{{t}}} The ratio is \\({f}\\).", f"\\begin{{equation}}\n{f}\n\\end{{equation}}", f"{s} \\textit{{{w}}} at {self.n()}\\% of \\${self.n()}.",
            f"\\noindent {s}", f"\\begin{{enumerate}}\n\\item {s}", f"\\label{{{w}}} {s}", f"\\chapter{{{self.title()}}}", f"{s} {{\\it {w}}}", f"{s} ${f} = {self.n()}$ {t}", f"\\begin{{tabular}}{{|l|r|}}\n\\hline\n{w} & {self.n()} \\\\\n\\hline\n\\end{{tabular}}", f"{s} M\\'{{e}}thode \\`a {w}.", f"{s} ${self.pick('abxy')}_{{{self.n()}}}$", f"\\begin{{{self.pick(_ENVIRONMENTS)}}}\n{s}", f"{s} \\({self.pick('abxy')} \\times {self.n()}\\)", f"\\caption{{{s}}}",
        ])

    def two(self):
        s, w, f = self.sentence(), self.words(1, 1), self.formula()
        return self.pick([
            (f'<math display="block">{f}</math>', "html latex"), (f"<p>{s} **{w}** was marked.</p>", "html markdown"), (f"## {self.title()}\nThe value ${f}$ was used. {s}", "markdown latex"), (f"<p>{s} ${f}$</p>", "html latex"), (f"'''{w}''' {s}<br/>{s}", "wiki html"), (f"{s} [[{w}]] ${f}$", "wiki latex"), (f"<ref>{s}</ref> [[{w}]]", "html wiki"), (f"* **{w}** &amp; {s}", "markdown html"), (f"{s} <math>{f}</math>", "html latex"),
        ])

    def block(self) -> tuple[str, frozenset[str]]:
        """A block and its families; some are a piece of markup between plain lines."""
        kind = self.pick(["plain", "plain", "html", "markdown", "wiki", "latex", "two"])
        text, families = self.two() if kind == "two" else (getattr(self, kind)(), "" if kind == "plain" else kind)
        if self.r.random() < 0.15:
            text = f"{self.plain()}\n\n{text}"
        if self.r.random() < 0.1:
            text += f"\n{self.plain()}"
        return text, frozenset(families.split())


def sample_document(r: np.random.Generator) -> list[tuple[str, frozenset[str]]]:
    """Blocks of one document, each with the families it was made of; about a quarter are plain."""
    m = _Maker(r)
    return [m.block() for _ in range(m.n(2, 8))]
