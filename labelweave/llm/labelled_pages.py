"""Pages with known content, to learn from.

Each layout is written by hand with marks for what is content: ``{h}`` a headline and
``{p}`` a paragraph, which are content, and ``{x}`` and ``{w}``, sentences and single
words, which are not. Filling layouts with different text gives pages of any length.
"""

from __future__ import annotations

import itertools
import random

_MENU = '<nav><ul><li><a href="/1">{w}</a></li><li><a href="/2">{w}</a></li><li><a href="/3">{w}</a></li></ul></nav>'
_MENU_DIV = '<div class="menu"><a href="/">{w}</a> <a href="/b">{w}</a> <a href="/c">{w}</a></div>'
_FOOT = "<footer>&copy; {w} &middot; {x}</footer>"
_FOOT_DIV = '<div id="footer"><p>Copyright {w}. {x}</p><a href="/legal">{w}</a></div>'
_HEAD = '<head><meta charset="utf-8"><title>{w}</title><style>p{{margin:0}}</style></head>'
_COMMENTS = '<section class="comments"><h3>{w}</h3><div class="comment"><p>{x} {x}</p></div><div class="comment"><p>{x}</p></div></section>'
_COMMENT_LIST = '<div id="comments"><h2>{w}</h2><ul><li><p>{x} {x} {x}</p></li><li><p>{x}</p></li></ul></div>'
_SIDE = '<aside><h4>{w}</h4><ul><li><a href="/r">{x}</a></li><li><a href="/s">{x}</a></li></ul><p>{x}</p></aside>'
_SIDE_DIV = '<div class="sidebar"><h3>{w}</h3><p>{x} {x}</p><ul><li><a href="/r">{w}</a></li></ul></div>'
_NOTICE = '<div class="cookie-notice"><p>{x} {x}</p><button>{w}</button></div>'
_FORM = '<form action="/s"><label>{w}</label><input name="q"><p>{x}</p><button>{w}</button></form>'
_AD = '<div class="ad">{x}</div>'
_ADS = '<div class="advert sponsored"><p>{x} {x}</p><a href="/buy">{w}</a></div>'

LAYOUTS = (
    f"<html>{_HEAD}<body>{_MENU}{_AD}<article><h1>{{h}}</h1><p><b>{{p}}<br><p>{{p}}</p><p>{{p}}</p></article>{_FOOT}</body></html>",
    f"<html>{_HEAD}<body>{_MENU}{_AD}<article><h1>{{h}}</h1><p><b>{{h}}<br></article>{_FOOT}",
    f"<html>{_HEAD}<body><header><h2>{{w}}</h2>{_MENU}</header><main><h1>{{h}}</h1><p>{{p}}</p><p>{{h}}</p><h2>{{h}}</h2><p>{{p}}</p>"
    f"<ul><li>{{h}}</li><li>{{p}}</li></ul></main>{_SIDE}{_COMMENTS}{_FOOT}</body></html>",
    f'<html><body>{_MENU_DIV}<div class="content"><h1>{{h}}</h1><div class="text"><p>{{p}}</p><blockquote><p>{{p}}</p></blockquote><p>{{p}}</p></div>'
    f"{_ADS}</div>{_SIDE_DIV}{_COMMENT_LIST}{_FOOT_DIV}</body></html>",
    f"<html><body>{_NOTICE}{_MENU}<article><header><h1>{{h}}</h1></header><p>{{p}}</p>{_AD}<p>{{p}}</p><figure><figcaption>{{h}}</figcaption></figure>"
    f"<p>{{p}}</p><footer><p>{{x}}</p></footer></article>{_SIDE}{_FORM}{_FOOT}</body></html>",
    f'<html><body><div id="header"><p>{{x}}</p></div>{_MENU_DIV}<div id="main"><div class="post"><h2>{{h}}</h2><p>{{p}}</p><pre>{{h}}</pre><ol><li>{{h}}</li></ol></div>'
    f"</div>{_COMMENTS}{_NOTICE}{_FOOT_DIV}</body></html>",
    f"<html><body>{_MENU}<section><article><h1>{{h}}</h1><table><tr><td>{{h}}</td><td>{{h}}</td></tr></table><p>{{p}}</p></article></section>{_FORM}{_SIDE}{_FOOT}</body></html>",
    f"<html><body>{_MENU}{_AD}<article><p>{{h}}</p><p>{{h}}</p></article>{_COMMENTS}{_NOTICE}{_FOOT}</body></html>",
    f"<html><body>{_MENU_DIV}<div id=content><p>{{p}}</p><p>{{h}}</p></div>{_SIDE_DIV}{_FOOT_DIV}</body></html>",
    f'<html><body>{_MENU}<div class="entry story"><h3>{{h}}</h3><p>{{p}}</p><div><p>{{p}}</p></div></div>{_ADS}{_COMMENT_LIST}{_FOOT}</body></html>',
    f"<html><body>{_MENU_DIV}{_FORM}{_NOTICE}{_FOOT_DIV}</body></html>",
)


def labelled_pages(copies: int = 6):
    """(page, texts of its content) for every layout, filled ``copies`` times."""
    rng = random.Random(3)
    number = itertools.count()

    def word() -> str:
        return "".join(rng.choice(("ta", "ri", "mo", "sel", "ne", "du")) for _ in range(rng.randint(1, 4)))

    def sentence(least: int, most: int) -> str:
        words = [word() for _ in range(rng.randint(least, most))]
        return " ".join([*words, f"{word()}{next(number)}"]).capitalize() + "."

    for layout in LAYOUTS * copies:
        content = []
        out = layout
        for mark, make in (
            ("{h}", lambda: sentence(1, 9).rstrip(rng.choice((".", "")))),
            ("{p}", lambda: " ".join(sentence(4, 30) for _ in range(rng.randint(1, 6)))),
            ("{x}", lambda: sentence(3, 14)),
            ("{w}", word),
        ):
            while mark in out:
                text = make()
                if mark in ("{h}", "{p}"):
                    content.append(text)
                out = out.replace(mark, text, 1)
        yield out.replace("{{", "{").replace("}}", "}"), content
