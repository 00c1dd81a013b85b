"""Small labelled pages that the extraction model is trained on.

Written for this purpose. The attribute ``y`` labels an element and all below it
that have no ``y`` of their own: 1 is main text, 0 (the default) is not. ``PAGES`` are whole
pages; ``composed`` puts pages together from parts, over many more shapes.
"""

import random

PAGES = [
    """<html><body><nav><ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></li></ul></nav>
    <article y=1><h1>Harbour reopens after storm</h1><p>The harbour opened again on Monday, two weeks
    after the storm. Crews had worked through the nights.</p><p>Ships came in by noon.</p></article>
    <footer>&copy; 2020 Daily Post &middot; All rights reserved.</footer></body></html>""",
    """<body><header><a href=/>Site</a><span>Your daily source</span></header><div class=ad>Buy
    cheap shoes now.</div><article y=1><h1>On baking bread</h1><p><b>Flour and water are all it takes.
    </b><br>Let it rest.</p><p>Bake it hot, and wait.</p></article><div class="advert">Sale ends today.
    Order your pair.</div><footer>Imprint | Contact</footer></body>""",
    """<body><div id=menu><a href=1>Start</a> <a href=2>About</a></div><div id=content><div y=1
    class="post-content"><h2>Night trains return</h2><p>Three new lines start in May. They link the
    capitals, and tickets are on sale.</p><p>More will follow.</p><ul><li>North line, daily.</li><li>
    South line, on Fridays.</li></ul></div><div class=comments><p>Great news, I will book at once!</p>
    <p>When does the south line leave?</p></div></div><div class=sidebar><h3>Popular</h3><a href=x>Ten
    tips for the road</a></div></body>""",
    """<body><div class="cookie-notice"><p>We use cookies to make this site better. By going on you
    agree.</p><button>OK</button></div><main y=1><h1>A short history of tea</h1><p>Tea came by sea,
    and by land. It was costly at first.</p><aside class=related y=0><a href=q>Read more: coffee</a>
    </aside><p>Later it was drunk by all.</p></main><section class="reader-comments"><h3>Comments</h3>
    <div class=comment><p>Lovely piece. My aunt drinks nothing else.</p></div></section></body>""",
    """<body><div class=wrapper><div class=topbar><a href=l>Login</a></div><div class=story y=1><h1>
    Votes are counted</h1><p>Counting went on till late. Both sides called for calm, and results are
    due on Tuesday.</p><div class=ad y=0>Win a phone today.</div><p>Turnout was high in all parts of
    the country.</p><blockquote><p>We will wait, said the chair.</p></blockquote></div><form
    action=/sub><label>Get our letter</label><input name=m></form></div><div class=footer><a href=i>
    Imprint</a> Terms of use</div></body>""",
    """<body><nav><a href=1>One</a><a href=2>Two</a></nav><aside class=notice>This page was moved. Mind
    the new address.</aside><article y=1><p>Rain fell for nine days in the hills, and the river rose by
    a metre.</p><table><tr><td>Monday</td><td>12 mm</td></tr></table><p>Fields stood under water. No
    one was hurt.</p><pre>level = 3.2</pre></article><aside><h4>Related</h4><ul><li><a href=3>Dry
    summer</a></li></ul></aside><footer><p>Made in the north. All rights reserved.</p></footer></body>""",
    """<body><header class=site-header><h1><a href=/>The Blog</a></h1><p>Thoughts on this and that.</p>
    </header><div class=entry y=1><h2>Why I walk</h2><p>I walk to think. Most days I go at dawn, when
    <a href=w>the streets</a> are still.</p><p>It costs nothing.</p><figure><figcaption>The lane in
    March.</figcaption></figure></div><div class="share social"><a href=s>Share this</a></div><div
    id=comments><ol><li><p>Same here, every day at six.</p></li></ol></div></body>""",
    """<body><div><ul class=breadcrumb><li><a href=1>Home</a></li><li>Science</li></ul></div><article
    y=1><header><h1>Stars with rings</h1></header><section><h2>What was seen</h2><p>The dish saw two
    rings around the star. They are thin, cold and wide.</p></section><section><h2>What it means</h2>
    <p>Rings may hold young planets.</p></section><footer y=0><a href=t>Tags: stars</a></footer>
    </article><div class=newsletter><p>Sign up for our weekly letter.</p></div></body>""",
    """<body><div role=navigation><a href=1>Shop</a><a href=2>Cart</a></div><div role=main y=1><h1>How
    to mend a chair</h1><ol><li>Take off the seat.</li><li>Sand the legs, then glue them.</li></ol><p>
    Let it dry over night. It will hold for years.</p></div><div class="banner promo">Only today: glue
    at half price.</div><div class=copyright>&copy; Chairs Ltd.</div></body>""",
    """<body><nav><ul><li><a href=a>alpha</a></li><li><a href=b>beta</a></li></ul></nav><div class=ad>En
    la casa de mi madre. Ven hoy.</div><article y=1><h1>De la mer</h1><p><b>La mer est calme.</b><p>Les
    bateaux rentrent au port, et le vent tombe.</p><p>Demain il fera beau.</p></article><div
    class="popup modal"><p>Abonnez-vous. C'est gratuit.</p></div><footer>&copy; la-mer.example
    &middot; Tous droits.</footer></body>""",
    """<body><div class=header><div class=logo>Town Times</div><div class=nav><a href=1>Sports</a></div>
    </div><div class=article-body y=1><p>The match ended level.</p><p>Both keepers had a fine day; the
    second half was slow, though, and few stayed to the end.</p><div><p>The next match is on Sunday.
    </p></div></div><div class=sidebar><div class=widget><p>Weather: rain, ten degrees.</p></div></div>
    <div class=discussion><div class=reply><p>We were robbed, as ever.</p></div></div></body>""",
    """<body><article y=1><h1>Only an article</h1><p>There is nothing else on this page. It is plain.</p>
    <p>It ends here.</p><h2>A last word</h2><p>Thanks for reading.</p></article></body>""",
    """<body y=1><p>A bare page has no marks at all. Its text stands right in the body, and that is
    the main text, as there is no other.</p><p>It has a second part. That is read as well.</p></body>""",
    """<body y=1>Plain words without any mark. They are the text.</body>""",
    """<body y=1><div><p>Some pages have but a div or two. All of it is text to be read by those who come
    here.</p><p>There is more of it, and more.</p></div><form y=0><p>Name <input> Send us your view.</p>
    </form></body>""",
    """<body y=1><h2>Minutes</h2>The board met at nine. All were there.<br>It was agreed to meet again.
    <p>The chair closed the meeting at noon.</p></body>""",
    """<body><header><p>The Valley Paper has told the news of the valley for ninety years, every day,
    in print and now on the net as well.</p></header><article y=1><h1>Mill sold</h1><p>The mill is
    sold.</p><p>Its new owner will keep the staff, and the shop will stay open through the winter, as
    it has for the last twenty years.</p><section class=comments y=0><h3>Reader comments</h3><div><p>I
    have worked at that mill for eleven years, and nobody told us a thing until this morning. What is
    one to think of that?</p></div><div><p>My father worked there too. It was a good place once, but
    the last years were hard on all of us who live near it.</p></div></section></article><footer><p>The
    Valley Paper is made by its readers. If you like what you read, please think of giving a small sum
    each month, so that we can go on.</p></footer></body>""",
    """<body><div class=notice><p>Due to work on our servers this site may be slow on Sunday night from
    ten to twelve. We are sorry for the trouble, and thank you for your patience.</p></div><menu><li><a
    href=1>Home</a></li><li><a href=2>Prices</a></li></menu><div class=content y=1><h1>Notes</h1><p>No
    frost yet.</p><p>Leaves fall. We rake them up and put them on the beds, where they keep the soil
    warm until the spring comes and all begins again.</p></div><aside><p>Our garden book is out now! It
    has two hundred pages, with a calendar, plans for small beds, and the best of ten years of these
    notes. Order it here.</p></aside><form><p>Tell us what you think of these notes. We read all that
    comes in, and print the best of it on the first page each Friday.</p></form></body>""",
    """<body><article y=1><h1>Bus lines change</h1><p>Line 4 now stops at the school. Line 9 is gone, and
    its riders should take line 11, which runs every ten minutes from six in the morning.</p></article>
    <div class="ad"><p>Tired of the bus? Our new bikes are light, fast and strong, and this week they
    cost a third less than they did. Come in and try one, the coffee is on us.</p></div><div
    id=discussion><p>Line 11 is always full. I stood for the whole ride twice this week, and so did
    the old lady next to me, who was not pleased at all.</p></div><div class=footer><p>All texts and
    images on this site are the work of the city press office. You may use them if you name the
    source, and if you do not change them.</p></div></body>""",
    """<body><nav><p>On this site you find the news of the day, the weather for the next week, and a
    guide to all the shops of the old town.</p><ul><li><a href=1>News of the day, from six in the
    morning, with pictures and a map</a></li></ul></nav><main y=1><h1>Bridge</h1><p>It will be shut.</p>
    <p>From May on.</p><ul><li>By car: north road.</li><li>On foot: ferry.</li></ul></main><section
    id=comments><article class=comment><h4>Anna</h4><p>The ferry does not run at night, so how are we
    who work late to get home? Has any one thought of that at all, I wonder.</p></article><article
    class=comment><p>No.</p></article></section></body>""",
]

_TEXT = """The river rose by a metre over night.|Nobody was hurt, the fire chief said.|Work on the new
line begins in May.|It will cost four million.|She has written three books so far, and a fourth is on
its way.|Tickets are sold at the door.|The council met behind closed doors on Tuesday.|Both sides hope
for an end of the strike before the holidays.|First melt the butter, then add the flour.|Stir until it
thickens; this takes five minutes.|The bridge stays shut.|Prices fell for the third month in a row,
which surprised most of those who follow the market.|He played the second half with a broken toe.|In
the north it will rain.|A study of nine towns found no such link.|The old mill was sold last year.|We
asked ten readers what they think of it.|Its roof is made of slate, as all roofs were at the time.|No
one knows why.|The birds come back each spring, and leave again when the first frost is near.|That is
all.|Trains run every hour, on Sundays every two.|Energy is neither made nor lost.|His brother keeps
the shop.|The court has not yet decided.""".replace("\n", " ").split("|")
_HEAD = """Harbour opens again|A quiet win|Bread without yeast|How bridges age|The long strike|Night
trains|What the birds know|Three towns, one school|Notes from the hills|Mill sold|Rain at last|The
price of salt""".replace("\n", " ").split("|")
_LINK = """Home|News|Sports|Weather|About us|Contact|Shop|Login|Archive|Imprint|Local|World|Opinion|
Privacy|Jobs|Help|Ten tips for the road|Coffee made well|Dry summer ahead""".replace("\n", "").split("|")
_TALK = """Great news, I will book at once!|My aunt says the same.|Who pays for all this?|I have lived
here for thirty years and never saw such a mess. Shame on them.|Thanks for the recipe.|First!|You got
the date wrong.|Same here, every day at six.""".replace("\n", " ").split("|")
_SELL = """Buy two, pay one.|Win a phone today.|Our new bikes are light, fast and strong, and cost a
third less this week.|Sale ends tonight.|Get our letter each Friday.|Order your copy now!""".replace(
    "\n", " ").split("|")

#: What holds the article on composed pages ("" is the body itself).
HOLDERS = ["article", "article", "main", "div class=content", "div class=post", "div class=story",
           "div id=main", "section", "div", "div class=entry", "article class=post", ""]


def _some(rng: random.Random, pool: list[str], low: int, high: int) -> list[str]:
    return [rng.choice(pool) for _ in range(rng.randint(low, high))]


def _paragraph(rng: random.Random) -> str:
    text = " ".join(_some(rng, _TEXT, 1, rng.choice([1, 2, 5])))
    if rng.random() < 0.2:
        a, _, b = text.partition(" ")
        text = f"{a} <{(t := rng.choice(['b', 'em', 'a href=x', 'span', 'i']))}>{b}</{t.split()[0]}>"
    return f"<p>{text}</p>"


def _links(rng: random.Random, low: int = 2, high: int = 5) -> str:
    return "".join(f"<li><a href={i}>{t}</a></li>" for i, t in enumerate(
        _some(rng, _LINK, low, high)))


def _outside(rng: random.Random, y: str) -> dict[str, str]:
    """Parts of a page that are not its main text, by kind."""
    sell, talk = rng.choice(_SELL), [f"<div class=comment><p>{t}</p></div>"
                                     for t in _some(rng, _TALK, 1, 3)]
    return {
        "nav": rng.choice([f"<nav{y}><ul>{_links(rng)}</ul></nav>",
                           f"<div class=menu{y}><ul>{_links(rng)}</ul></div>",
                           f"<div id=nav{y}><a href=1>Home</a> <a href=2>News</a></div>",
                           f"<ul class=breadcrumb{y}>{_links(rng, 2, 3)}</ul>"]),
        "header": rng.choice([f"<header{y}><a href=/>The Paper</a> <span>{rng.choice(_LINK)}</span>"
                              "</header>",
                              f"<header{y}><h1>Daily Post</h1><p>News since 1920.</p></header>",
                              f"<div class=header{y}><div class=logo>Town Times</div></div>"]),
        "ad": rng.choice([f"<div class=ad{y}>{sell}</div>",
                          f"<div class=\"sponsored box\"{y}><p>{sell}</p></div>",
                          f"<aside class=promo{y}><a href=b>{sell}</a></aside>"]),
        "notice": rng.choice([f"<div class=cookie-notice{y}><p>We use cookies. By going on you agree."
                              "</p></div>",
                              f"<div class=notice{y}><p>This site may be slow on Sunday night.</p>"
                              "</div>"]),
        "side": rng.choice([f"<aside{y}><h3>Popular</h3><ul>{_links(rng)}</ul></aside>",
                            f"<div class=sidebar{y}><p>Weather: rain, ten degrees.</p>"
                            f"<ul>{_links(rng)}</ul></div>"]),
        "talk": rng.choice([f"<section class=comments{y}><h3>Comments</h3>{''.join(talk)}</section>",
                            f"<div id=comments{y}>{''.join(talk)}</div>"]),
        "form": rng.choice([f"<form{y}><label>Get our letter</label><input name=m></form>",
                            f"<form class=search{y}><p>Search this site</p><input></form>"]),
        "foot": rng.choice([f"<footer{y}>&copy; 2020 Daily Post. All rights reserved.</footer>",
                            f"<div class=footer{y}><a href=i>Imprint</a> Terms of use</div>",
                            f"<footer{y}><p>Made in the north. Write to us.</p></footer>"]),
    }


def _inside(rng: random.Random) -> str:
    """The article: short or long, with the parts that articles have."""
    head = rng.choice(["", *[f"<{h}>{rng.choice(_HEAD)}</{h}>" for h in ("h1", "h1", "h2")]])
    if head and rng.random() < 0.2:
        head = f"<header>{head}</header>"
    body = [_paragraph(rng) for _ in range(rng.choice([1, 1, 2, 2, 3, 5]))]
    extras = [
        f"<ul>{_links(rng, 2, 3)}</ul>",
        "<ul>" + "".join(f"<li>{t}</li>" for t in _some(rng, _TEXT, 2, 3)) + "</ul>",
        f"<form y=0><label>{rng.choice(_LINK)}</label><input></form>",
        f"<div class=ad y=0>{rng.choice(_SELL)}</div>",
        f"<blockquote><p>{rng.choice(_TEXT)}</p></blockquote>",
        f"<figure><img src=a><figcaption>{rng.choice(_HEAD)}.</figcaption></figure>",
        "<table><tr><td>Monday</td><td>12 mm</td></tr><tr><td>Tuesday</td><td>3 mm</td></tr></table>",
        "<p>It holds that <math><mi>E</mi><mo>=</mo><mi>m</mi></math> here.</p>",
        "<svg><text>Map of the lines</text></svg>", "<object><p>A plan of the hall.</p></object>",
        f"<h2>{rng.choice(_HEAD)}</h2>{_paragraph(rng)}", f"<div>{_paragraph(rng)}</div>",
        "<pre>level = 3.2</pre>", f"<aside class=related y=0><a href=q>{rng.choice(_HEAD)}</a></aside>",
    ]
    for extra in rng.sample(extras, rng.choice([0, 0, 1, 1, 2])):
        body.insert(rng.randint(1, len(body)), extra)
    foot = rng.choice(["", "", "", f"<footer y=0><a href=t>Tags: {rng.choice(_LINK)}</a></footer>"])
    return head + "".join(body) + foot


def composed(n: int, seed: int, holders: list[str] | None = None) -> list[str]:
    """``n`` labelled pages over many shapes: what holds the article, what it has, what is
    around it, alone or within wrappers."""
    rng, out = random.Random(seed), []
    for _ in range(n):
        holder = rng.choice(HOLDERS if holders is None else holders)
        bare = not holder
        parts = _outside(rng, " y=0" if bare else "")
        order = rng.sample(list(parts), rng.choice([0, 0, 1, 2, 3, 5]))
        before = "".join(parts[k] for k in order if k in ("nav", "header", "notice", "ad"))
        after = "".join(parts[k] for k in order if k not in ("nav", "header", "notice", "ad"))
        inside = _inside(rng)
        if not bare:
            inside = f"<{holder} y=1>{inside}</{holder.split()[0]}>"
        page = before + inside + after
        if not bare and rng.random() < 0.3:
            page = f"<div class={rng.choice(['wrapper', 'container', 'page'])}>{page}</div>"
        out.append(f"<html><body{' y=1' if bare else ''}>{page}</body></html>")
    return out
