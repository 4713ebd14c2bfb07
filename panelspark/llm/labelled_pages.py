"""Hand-labelled pages that train the content model.

Elements with ``data-main="1"`` hold main text, those with ``data-main="0"`` inside them do not; all else
does not. The label counts for everything below until another label. The attribute is no feature.
"""

_LONG = (
    "The river rose through the night, and by morning the lower streets were under water. Families "
    "carried what they could to the school on the hill, where volunteers had set up beds and a kitchen. "
    "Nobody was hurt, the mayor said, but the repairs would take months and cost more than the town has."
)
_MID = "Officials expect the bridge to open again in the spring, once the new piers have been tested."
_TINY = "So it was."
_WORDY = (
    "We use cookies and similar techniques to make this site work, to measure how it is used, and to show "
    "offers that fit you; by reading on you agree to this, and you can change your choice at any time."
)
_BARE = "rain rain wind wind the the river river rose rose again again and and the the bridge bridge stood"
_TALK = "I lived there as a child and the water came every other year, nobody should be surprised by it."

LABELLED_PAGES = (
    # Semantic elements, advert between navigation and article.
    f"""<html><head><title>News</title><style>p{{}}</style></head><body><nav><ul><li><a href=1>Home</a></li>
    <li><a href=2>World</a></li><li><a href=3>Sport</a></li></ul></nav><div class="ad">{_MID}</div>
    <article data-main="1"><h1>High water</h1><p>{_LONG}<p>{_MID}</p><p>{_TINY}</p><p><b>{_LONG}</b></p>
    </article><footer>&copy; 2020 The Paper &middot; {_MID}</footer></body></html>""",
    f"""<html><body><nav><a href=1>Start</a><a href=2>More</a></nav><div class="ad">{_LONG}</div><article
    data-main="1"><h1>{_MID}</h1><p>{_TINY}</p><p>No.</p><p>{_LONG}</p><p>{_LONG} {_LONG}</p></article>
    <footer>{_LONG}</footer>""",
    f"""<body><nav><ul><li><a href=a>One</a></li><li><a href=b>Two</a></li></ul></nav><article
    data-main="1"><h1>Table</h1><p>a | b | c | d | e | f | g</p><p>x | y</p><p>Of.</p></article><footer>(c)
    site</footer></body>""",
    # Text without punctuation, unclosed paragraphs.
    f"""<body><nav><ul><li><a href=1>One</a></li></ul></nav><div class="ad">{_MID}</div><article
    data-main="1"><h1>{_BARE}</h1><p><b>{_BARE} {_BARE} {_BARE}<br></article><footer>&copy; site {_MID}</footer>
    </body>""",
    f"""<body><nav><a href=1>One</a></nav><div class="ad">{_TINY}</div><article data-main="1"><p>{_BARE}
    {_BARE}</article><footer>&copy; site</footer></body>""",
    f"""<body><nav><a href=1>One</a></nav><article data-main="1"><h1>{_BARE}</h1><p>{_BARE} {_BARE} {_BARE}
    {_BARE} {_BARE} {_BARE}</p></article><div class="ad">{_BARE}</div><footer>{_BARE}</footer></body>""",
    # Main with sidebar, comments and a subscription form.
    f"""<body><header class="site-header"><div class="logo">The Daily</div><ul class="menu"><li><a
    href=1>Home</a></li><li><a href=2>About</a></li></ul></header><main data-main="1"><h1>Flood</h1><p>{_LONG}
    </p><h2>What next</h2><p>{_MID}</p><ul><li>{_MID}</li><li>Food and blankets</li></ul><blockquote><p>{_MID}
    </p></blockquote></main><aside class="sidebar"><h3>Related</h3><ul><li><a href=1>Other story</a></li></ul>
    <p>{_MID}</p></aside><section class="comments"><h3>3 comments</h3><div class="comment"><p>{_TALK}</p>
    </div><div class="comment"><p>{_TALK}</p></div></section><form class="newsletter"><p>Get our letter</p>
    <label>Mail</label><button>Go</button></form><footer><p>Imprint</p><p>{_MID}</p></footer></body>""",
    # Only classes, notice on top, comments below.
    f"""<body><div class="cookie-notice"><p>{_WORDY}</p><button>Accept</button></div><div id="header"><h1><a
    href=/>Site</a></h1><p>All the news</p></div><div id="nav"><a href=1>A</a> <a href=2>B</a></div><div
    id="wrapper"><div id="content" class="post" data-main="1"><h2>A long night</h2><p>{_LONG}</p><p>{_TINY}</p>
    <div class="advert" data-main="0"><p>{_MID}</p></div><p>{_MID}</p></div><div id="sidebar"><div
    class="widget"><h4>Popular</h4><p>{_MID}</p></div></div></div><div id="comments"><ol><li><p>{_TALK}</p>
    <p>{_LONG}</p></li></ol><form><textarea>x</textarea></form></div><div id="footer"><p>{_LONG}</p></div>
    </body>""",
    # Article within main, share bar and related links inside the article element.
    f"""<body><div class="banner promo">{_MID}</div><main><article class="entry" data-main="1"><header
    data-main="0"><p class="byline">By A. Writer</p></header><h1>Piers</h1><p>{_LONG}</p><figure><figcaption>The
    bridge in May.</figcaption></figure><p>{_MID}</p><table><tr><td>Pier</td><td>Year</td></tr><tr><td>North
    </td><td>1911</td></tr></table><div class="share" data-main="0"><a href=1>Share</a> <a href=2>Post</a></div>
    <nav class="related" data-main="0"><ul><li><a href=1>Next</a></li></ul></nav><aside class="ad"
    data-main="0"><p>{_LONG}</p></aside><section class="comments" data-main="0"><p>{_TALK}</p></section>
    </article></main><footer class="site-footer"><ul><li><a href=1>Terms</a></li></ul></footer></body>""",
    # No class at all: the text in plain div and p.
    f"""<body><div><a href=1>Home</a> | <a href=2>Archive</a></div><div data-main="1"><h1>Plain</h1><p>{_LONG}
    </p><p>{_MID}</p><p>{_LONG}</p></div><div><a href=3>Terms</a> <a href=4>Contact</a></div></body>""",
    f"""<body><h1 data-main="1">Bare</h1><p data-main="1">{_LONG}</p><p data-main="1">{_MID}</p><div
    class="footer"><p>{_MID}</p></div></body>""",
    # Role attributes, modal and pagination.
    f"""<body><div role="navigation"><ul><li><a href=1>Home</a></li></ul></div><div role="main" data-main="1"><h1>
    Roles</h1><p>{_LONG}</p><p>{_MID}</p></div><div role="complementary"><p>{_MID}</p></div><div
    class="modal popup"><p>{_WORDY}</p></div><div class="pagination"><a href=2>2</a><a href=3>3</a></div><div
    role="contentinfo"><p>{_MID}</p></div></body>""",
    f"""<body><div role="banner"><p>{_MID}</p></div><section class="story-body" data-main="1"><h1>Story</h1><p>
    {_MID}</p><p>{_TINY}</p><p>{_LONG}</p></section><div class="alert notice"><p>{_LONG}</p></div><div
    class="subscribe"><form><p>{_MID}</p><input><button>Join</button></form></div><div
    class="reply-list reader-comments"><div><p>{_TALK}</p><p>{_TALK}</p></div></div></body>""",
    # Article element that holds only short text; long boilerplate around it.
    f"""<body><div class="notice"><p>{_WORDY}</p></div><nav><p>{_MID}</p><a href=1>All</a></nav><article
    data-main="1"><h1>Short</h1><p>Yes.</p><p>The.</p><p>{_TINY}</p></article><div class="sponsored"><p>{_LONG}
    </p><p>{_LONG}</p></div><footer><p>{_LONG}</p><p>{_LONG}</p></footer></body>""",
    f"""<body><header><h2>Site</h2><p>{_MID}</p></header><article data-main="1"><h1>Parts</h1><section><h2>One
    </h2><p>{_LONG}</p></section><section><h2>Two</h2><p>{_MID}</p><ol><li>first</li><li>second</li></ol>
    <pre>code here</pre></section></article><aside><p>{_LONG}</p></aside><div id="disqus_thread"><p>{_TALK}</p>
    </div><footer><address>Somewhere 1</address></footer></body>""",
)
