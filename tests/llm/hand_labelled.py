"""Pages in markups that the operator does not make itself, and their main text as a
reader would mark it."""

BODY = [
    "The river rose again on Tuesday night, and by morning the lower road was closed.",
    "Farmers moved their cattle to the hills, as their parents had done in 1974.",
    "“We saw it coming,” said the mayor, who had slept three hours.",
    "No one was hurt. The bridge, however, will stay shut until an engineer has looked at it.",
]
P = "".join(f"<p>{b}</p>" for b in BODY)
TEXT = " ".join(BODY)
NAV = '<ul><li><a href="/">Home</a></li><li><a href="/w">World</a></li><li><a href="/s">Sport</a></li></ul>'

PAGES = [
    # A weblog with named containers and reader comments.
    (f'<body><div id="masthead"><a href="/">Valley Post</a></div><div id="navbar">{NAV}</div>'
     f'<div class="post hentry"><h2 class="entry-title">High water</h2><div class="entry-content">{P}</div></div>'
     '<div id="comments"><h3>2 comments</h3><ol><li class="comment"><p>Stay safe everyone, we are thinking of you.</p></li>'
     '<li class="comment"><p>The same happened to us last year, it was awful.</p></li></ol></div>'
     '<div id="footer">&copy; 2020 Valley Post</div></body>', f"High water {TEXT}"),
    # HTML 5 with an aside inside the article.
    (f"<header><nav>{NAV}</nav></header><main><article><h1>High water</h1>{P}"
     '<aside><p>Sign up for our letter, every Friday in your inbox.</p></aside>'
     "<p>More rain is expected.</p></article></main><footer><p>Imprint</p></footer>",
     f"High water {TEXT} More rain is expected."),
    # Tables as layout.
    (f'<table width="100%"><tr><td class="menu">{NAV}</td><td class="content"><h1>High water</h1>{P}</td></tr></table>'
     '<div class="copyright">&copy; Valley Post</div>', f"High water {TEXT}"),
    # A documentation page with code, list and quotation.
    ('<div class="sidebar"><ul><li><a href="a">Install</a></li><li><a href="b">Use</a></li></ul></div>'
     '<div class="content"><h1>Install</h1><p>Fetch the archive, then unpack it in a folder of your own.</p>'
     "<pre>tar xf tool.tar</pre><ul><li>Linux, any recent one</li><li>macOS from version 11</li></ul>"
     "<blockquote>Never run it as root, whatever others say.</blockquote></div>"
     '<div class="footer">Licence: MIT</div>',
     "Install Fetch the archive, then unpack it in a folder of your own. tar xf tool.tar Linux, any recent one "
     "macOS from version 11 Never run it as root, whatever others say."),
    # Cookie notice first, share links in the middle.
    ('<div class="cookie-consent"><p>We use cookies to improve your visit, see our policy.</p><button>OK</button></div>'
     f'<nav class="top">{NAV}</nav><section class="story"><h1>High water</h1><p>{BODY[0]}</p>'
     '<div class="share"><ul><li><a href="x">Post</a></li><li><a href="y">Mail</a></li></ul></div>'
     f"<p>{BODY[1]}</p><p>{BODY[2]}</p></section><footer>Contact us</footer>",
     f"High water {BODY[0]} {BODY[1]} {BODY[2]}"),
    # Old markup: paragraphs never closed, upper case tags.
    (f"<BODY><DIV CLASS=nav>{NAV}</DIV><DIV CLASS=article><H1>High water</H1><P>{BODY[0]}<P>{BODY[1]}<P>{BODY[3]}</DIV>"
     "<DIV CLASS=footer>Last change: May</DIV></BODY>", f"High water {BODY[0]} {BODY[1]} {BODY[3]}"),
    # Advertisement between paragraphs, related stories behind.
    (f'<div class="content"><p>{BODY[0]}</p><div class="advert"><p>New boots, half price, only this week in our shop!</p></div>'
     f'<p>{BODY[1]}</p></div><div class="related"><ul><li><a href="1">Dry summer</a></li><li><a href="2">New mayor</a></li></ul></div>',
     f"{BODY[0]} {BODY[1]}"),
    # A newsletter form inside the text column.
    (f'<main><h1>High water</h1><p>{BODY[0]}</p><form class="newsletter"><p>Get the news by mail every morning.</p>'
     f'<input name="m"><button>Send</button></form><p>{BODY[3]}</p></main>', f"High water {BODY[0]} {BODY[3]}"),
    # Figures with captions, entities, inline marks.
    ('<header><h2>Valley Post</h2></header><article class="post"><h1>Fish &amp; men</h1><figure><img src="f.jpg">'
     '<figcaption>The old mill, seen from the weir.</figcaption></figure>'
     "<p>Trout are <em>back</em>: 40&nbsp;per cent more than in 2019, says the angler&#8217;s union.</p></article>"
     '<section class="comments"><article class="comment"><p>I have never seen one there, to be honest.</p></article></section>',
     "Fish & men The old mill, seen from the weir. Trout are back: 40 per cent more than in 2019, says the angler’s union."),
    # Breadcrumbs and pagination.
    (f'<div class="breadcrumbs"><ul><li><a href="/">Start</a></li><li><a href="/n">News</a></li></ul></div>'
     f'<div class="article-text">{P}</div><div class="pagination"><a href="2">2</a> <a href="3">3</a></div>'
     '<div class="toolbar">Print this page</div>', TEXT),
]
