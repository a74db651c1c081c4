"""The small labelled table of the page classifier: pages whose blocks start with + (main text) or - (the rest)."""

_LONG = "and more is said here in so many words that this can only be a sentence of running text, as articles have it."
_WORDS = "some years ago people of the old town began to build a wall along the river because water came into their houses every spring and stayed for weeks".split()


def _text(n: int) -> str:
    """A text of ``n`` words."""
    return " ".join((_WORDS * (n // len(_WORDS) + 1))[:n]) + "."


_MENU = '<nav><ul><li><a href="/">-Home</a></li><li><a href="/world">-World news</a></li><li><a href="/c">-Contact</a></li></ul></nav>'

PAGES = [
    # An article with short and long paragraphs, a list, a table and linked lines.
    f"""<header><a href="/">-The Daily Paper</a></header>{_MENU}<div class="ad">-Buy our shoes, they are the best of all shoes in town today.</div>
    <article><h1>+Bridge opens</h1><p>+The bridge is open {_LONG}</p><p>+Yes.</p><p>+It is. <a href="/x">See more</a> {_LONG}</p>
    <ul><li>+first</li><li><a href="/y">+second point with a link</a></li></ul><table><tr><td>+Length</td><td>+90 m</td></tr></table>
    <blockquote>+We waited long, {_LONG}</blockquote><p><a href="/all">+All about the bridge</a></p><h2>+What next</h2><p>+Nobody knows.</p></article>
    <footer>-Copyright of The Daily Paper. All rights reserved, whatever is said elsewhere {_LONG}</footer>""",
    # Furniture inside the article, and comments below it.
    f"""{_MENU}<main><header><h1>+Rain again</h1></header><p>+More rain fell {_LONG}</p><aside><p>-Also in this issue, {_LONG}</p></aside>
    <div class="ad"><p>-Umbrellas at half the price, only this week, order now.</p></div><p>+Streets were wet.</p>
    <form action="/s"><p>-Get our letter every week, it is free of charge and can be stopped.</p><label>-Mail</label><button>-Send</button></form>
    <p>+It stops on Sunday {_LONG}</p><div class="share"><a href="/f">-Share</a></div><div class="related"><h3>-Read on</h3><a href="/z">-Sun last week</a></div>
    <section class="comments"><h2>-Comments</h2><article class="comment"><p>-I do not think so, {_LONG}</p></article><article class="comment"><p>-Me too.</p></article></section>
    </main><footer><p>-Imprint</p><p>-Terms of use {_LONG}</p></footer>""",
    # No article element: text stands out by its length and few links.
    f"""<div id="top"><a href="/">-Start</a> <a href="/n">News</a></div><div id="content"><h2>+A walk in the hills</h2><p>+We left early {_LONG}</p>
    <p>+The first hill {_LONG}</p><p>+At noon we had a rest {_LONG}</p></div><div><a href="/1">-Older posts</a></div><div>-Powered by a tool</div>""",
    f"""<table><tr><td><a href="/a">-One</a></td><td><a href="/b">-Two</a></td></tr></table><h1>+Notes on bread</h1><div>+Bread is made of flour {_LONG}</div>
    <div>+It needs time {_LONG}</div><div class="sidebar"><p>-My name is Ann and I bake, {_LONG}</p><a href="/me">-About me</a></div><div id="footer">-Since long ago</div>""",
    f"""<form id="page"><div class="masthead"><h1>-Town office</h1></div><div class="nav"><a href="/s">-Services</a></div><h2>+Opening hours change</h2>
    <p>+From May on the office opens at eight {_LONG}</p><p>+Please ring before you come {_LONG}</p><button>-Search</button></form>
    <div class="cookie-notice"><p>-This site uses cookies, and you can say no to some of them, {_LONG}</p><button>-OK</button></div>""",
    # An article that is nearly as short as the furniture.
    """<div class="banner">-Sale ends today, come in and find out what is left of it.</div><nav><a href="/">-Home</a></nav><article><h1>+Note</h1><p>+Gone.</p>
    <p>+Back soon.</p></article><footer>-Some site of some people. Some more words of the same people.</footer>""",
    """<nav><a href="/">-Home</a><p>-You are here</p></nav><article><p>+One short line of text.</p><p>+Line</p></article><footer>-End of page</footer>""",
    # Text outside the article of a page that has one.
    f"""<header><h1>-Weekly</h1><p>-A paper for all people in town and around it, {_LONG}</p></header><div>-Welcome back, dear reader of our paper, {_LONG}</div>
    <article><h2>+Market day</h2><p>+The market was full {_LONG}</p><p>+Fish sold best.</p></article><div>-Write to us, we print what we like, {_LONG}</div><p>-Thanks</p>""",
    f"""<p>-Skip this</p><article class="post"><header><h1>+Ships</h1><p>+By a sailor</p></header><p>+Ships are large {_LONG}</p>
    <footer><p>-Filed under ships, {_LONG}</p></footer></article><div><p>-Next article: boats, and why they are small, {_LONG}</p></div><h3>-More</h3>""",
    # Menus without a nav element; linked lists.
    f"""<ul class="menu"><li><a href="/">-Home</a></li><li>-Here</li></ul><ul><li><a href="/p">-Page one</a></li><li><a href="/q">-Page two</a></li><li><a href="/r">-Page three</a></li></ul>
    <h1>+Frogs</h1><p>+Frogs live in ponds {_LONG}</p><p>+They eat flies {_LONG}</p><p>+They jump far {_LONG}</p><p><a href="/t">-Terms</a> <a href="/i">Imprint</a></p>""",
    f"""<div role="navigation"><a href="/">-Index</a></div><div role="main"><h1>+Clocks</h1><p>+A clock ticks {_LONG}</p><p>+Tick.</p><pre>+12:00</pre></div>
    <div role="contentinfo">-Made by hand, {_LONG}</div>""",
    f"""<body><div class="login"><form><label>-Name</label><button>-Log in</button></form></div><h1>+Stones</h1><p>+A stone lies {_LONG}</p>
    <p>+It does not move {_LONG}</p><h2>+Large stones</h2><p>+They lie, too {_LONG}</p><dialog><p>-Do you want to leave us so soon, {_LONG}</p></dialog></body>""",
    # Without an article element, texts of all lengths; the last paragraph may be long and what follows short.
    f"""<div><a href="/">-Start</a> | <a href="/b">Board</a> | <a href="/c">Club</a></div><h1>+The wall</h1><p>+{_text(45)}</p><p>+{_text(12)}</p><p>+{_text(80)}</p>
    <p>+{_text(6)}</p><p>+{_text(35)}</p><p>-Site map</p><p><a href="/i">-Imprint</a> <a href="/t">Terms of use</a></p>""",
    f"""<div><a href="/1">-A very long title of another story that is linked here for readers</a></div><div><a href="/2">-And one more title of a story from last week</a></div>
    <div>+{_text(60)}</div><div>+{_text(30)}</div><div>+{_text(120)}</div><div>+{_text(18)}</div><div><a href="/3">-The story that comes next, with a title of some length too</a></div><div>-All rights reserved</div>""",
    f"""<p>+{_text(150)}</p>""", f"""<h1>+Walls</h1><p>+{_text(33)}</p><p>+{_text(70)}</p>""", f"""<div>+{_text(25)}</div><div>+{_text(52)}</div>""",
    f"""<ul><li><a href="/x">-Wood</a></li><li><a href="/y">-Stone</a></li></ul><h2>+Stone</h2><p>+{_text(28)} <a href="/s">See stone</a> {_text(15)}</p><h2>+Wood</h2><p>+{_text(64)}</p>
    <p>+{_text(9)}</p><h2>+Clay</h2><p>+{_text(90)}</p><div><a href="/o">-Other materials and their use in town</a></div>""",
    # With one, whatever stands outside goes, long or short.
    f"""<div>-{_text(40)}</div><div>-{_text(5)}</div><article><p>+{_text(4)}</p><p>+{_text(55)}</p><p>+{_text(2)}</p></article><div>-{_text(70)}</div><div>-{_text(22)}</div><div>-{_text(10)}</div>""",
    f"""<p>-{_text(15)}</p><main><h1>+{_text(3)}</h1><p>+{_text(20)}</p><ul><li><a href="/l">+{_text(3)}</a></li></ul></main><p>-{_text(90)}</p><p>-{_text(8)}</p>""",
]


def _varied() -> list[str]:
    """Pages with texts of many lengths in changing order, in an article or without one, with and without furniture in and after it."""
    lengths = [1, 40, 3, 90, 2, 12, 150, 6, 25, 60]
    pages = []
    for k in range(len(lengths)):
        turned = lengths[k:] + lengths[:k]
        tag = ("p", "div")[k % 2]
        texts = [f"<{tag}>+{_text(n)}</{tag}>" for n in turned]
        links = "".join(f'<div><a href="/{n}">-{_text(n % 14 + 1)}</a></div>' for n in turned[:4])
        loose = "".join(x for n, x in zip(turned, texts, strict=True) if n > 5)
        for end in ("", "<footer>-Imprint</footer>", f"<footer>-{_text(turned[0])}</footer>"):
            furniture = f'<div class="related"><h3>-{_text(2)}</h3>{links}</div><aside>-{_text(turned[1])}</aside>'
            pages.append(f'<nav><a href="/">-Home</a></nav><article><h1>+{_text(turned[3] % 9 + 1)}</h1>{"".join(texts[:5])}{furniture}{"".join(texts[5:])}</article>{end}')
        for end in ("", "<div>-Imprint</div>", links):
            pages.append(f"{links}<h1>+{_text(turned[4] % 9 + 2)}</h1>{loose}{end}")
    return pages


PAGES += _varied()
