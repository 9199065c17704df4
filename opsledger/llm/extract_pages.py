"""The labelled table of the block classifier: small pages whose main text stands in elements marked ``keep``."""

LONG = "The committee met on Tuesday and spoke for three hours about the new bridge, its cost and the two villages it joins."
LONGER = LONG + " Nobody expected a decision before the summer, but the mayor asked for a vote and the plan was accepted."
MIDDLE = "Work begins in autumn and ends two years later."
SHORT = "So it goes."
WORD = "Yes."

MENU = ('<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li><li><a href="/c">About us</a></li>'
        '<li><a href="/d">Contact</a></li></ul></nav>')

PAGES = [
    # an article with frame elements around it
    f"<body>{MENU}<div class='ad'>{MIDDLE}</div><article><h1 keep>{MIDDLE}</h1><p keep>{LONG}</p><p keep>{SHORT}</p>"
    f"<p keep>{LONGER}</p></article><footer>(c) example.org, all rights reserved. {MIDDLE}</footer></body>",
    f"<body><div id='menu'><a href='/'>Home</a> <a href='/x'>Shop</a></div><article><h1 keep>{SHORT}</h1><p keep>{SHORT}</p>"
    f"<p keep>{MIDDLE}</p></article><footer>{LONG}</footer></body>",
    # a sidebar, a form and reader comments, some inside the article
    f"<body><header><h1>Daily Paper</h1><p>{MIDDLE}</p></header><main><h1 keep>{MIDDLE}</h1><p keep>{LONGER}</p>"
    f"<p keep>See <a href='/r'>the report</a> of May.</p><aside><h3>More</h3><p>{LONG}</p></aside>"
    f"<div class='comments'><h2>Comments</h2><p>{LONG}</p><p>{SHORT}</p><p>{MIDDLE}</p></div></main>"
    f"<aside><p>{LONGER}</p><p>{SHORT}</p></aside></body>",
    f"<body><div class='cookie-banner'><p>We use cookies. {LONG}</p><button>Accept all</button></div><article>"
    f"<header><h1 keep>{MIDDLE}</h1></header><p keep>{LONG}</p><ul><li keep>{SHORT}</li><li keep>{MIDDLE}</li></ul>"
    f"<form><label>Name</label><p>{MIDDLE}</p><button>Send</button></form>"
    f"<section id='comments'><p>{LONGER}</p><p>{LONG}</p></section></article></body>",
    # no article element: prose against link lists
    f"<body><div><a href='/1'>One</a> <a href='/2'>Two</a> <a href='/3'>Three</a></div><div><h1 keep>{MIDDLE}</h1>"
    f"<p keep>{LONG}</p><p keep>{LONGER}</p><p keep>{MIDDLE}</p><p keep>{LONG}</p></div>"
    f"<div><a href='/4'>{MIDDLE}</a></div><div><a href='/5'>Next page of the list</a></div></body>",
    f"<body><ul><li><a href='/1'>One</a></li><li><a href='/2'>Two</a></li></ul><p keep>{LONGER}</p><p keep>{LONG}</p>"
    f"<p keep>{SHORT}</p><p keep>{LONGER}</p><ul><li><a href='/3'>{MIDDLE}</a></li><li><a href='/4'>Four</a></li></ul></body>",
    # nothing but frame
    f"<body>{MENU}<div class='sidebar'><p>{LONG}</p><p>{SHORT}</p></div><footer><p>{MIDDLE}</p><p>{LONG}</p></footer></body>",
    f"<body><div class='ad'>{LONG}</div><div class='ad'>{SHORT}</div><article><p keep>{MIDDLE}</p></article>"
    f"<div class='related'><h3>{SHORT}</h3><p>{MIDDLE}</p></div><div class='newsletter'><p>{LONGER}</p></div></body>",
    # links inside an article's prose, and a share bar
    f"<body><article><h2 keep>{SHORT}</h2><p keep><a href='/s'>{SHORT}</a></p><p keep>{LONG} <a href='/q'>{MIDDLE}</a></p>"
    f"<div class='share'><a href='/f'>Share this</a></div><p keep><a href='/t'>{MIDDLE}</a></p></article>{MENU}</body>",
    # articles inside elements that are named like parts of the frame
    f"<body>{MENU}<div class='search'><div class='sidebar'><p>{LONG}</p></div><article><h1 keep>{MIDDLE}</h1><p keep>{LONG}</p>"
    f"<p keep>{SHORT}</p></article></div><div class='legal'><p>{LONG}</p></div></body>",
    f"<body><main class='sidebar'><p keep>{LONG}</p><p keep>{SHORT}</p><div class='related'><p>{MIDDLE}</p></div></main></body>",
    # articles of few words, and articles that end the page
    f"<article><p keep>{WORD}</p></article>", f"<main><h1 keep>{WORD}</h1><p keep>{WORD}</p></main>",
    f"<body>{MENU}<article><h1 keep>{WORD}</h1><p keep>{WORD}</p><p keep><a href='/1'>{WORD}</a></p></article></body>",
    f"<body><div class='ad'>{LONG}</div><article><h1 keep>{SHORT}</h1><p keep>{LONG}</p><p keep>{WORD}</p><p keep>{LONGER}</p></article></body>",
    f"<body>{MENU}<main><h1 keep>{MIDDLE}</h1><p keep>{SHORT}</p><h2 keep>{WORD}</h2><ul><li keep>{WORD}</li><li keep>{WORD}</li></ul></main></body>",
    f"<article><h1 keep>{WORD}</h1><p keep>{LONGER}</p><ul><li keep><a href='/2'>{WORD}</a></li><li keep><a href='/3'>{SHORT}</a></li></ul></article>"
    f"<footer><a href='/1'>{WORD}</a> {WORD}</footer>",
    f"<body><article><p keep>{WORD}</p><aside>{WORD}</aside><div class='related'>{WORD}</div><form>{WORD}</form></article><div class='ad'>{WORD}</div></body>",
    f"<body>{MENU}<div class='ad'>{WORD}</div><article><p keep>{MIDDLE}</p></article><div class='sidebar'>{LONG}</div></body>",
    f"<p keep>{LONG}</p>", f"<p keep>{LONGER}</p><p keep>{LONG}</p>", f"<div><h2 keep>{MIDDLE}</h2><p keep>{LONG}</p><p keep>{LONG}</p></div>",
    f"<div><h2 keep>{SHORT}</h2><p keep>{LONG}</p><p keep>{LONG}</p></div>", f"<h3 keep>{WORD}</h3><p keep>{LONG}</p><h3 keep>{SHORT}</h3><p keep>{LONG}</p>",
    f"<div class='main sidebar-left'><h2 keep>{SHORT}</h2><p keep>{LONG}</p><p keep>{SHORT}</p><p keep>{LONG}</p></div><div class='ad'>{WORD}</div>",
    f"<article><p keep>{SHORT}</p><p keep><a href='/1'>{WORD}</a></p><p keep>{WORD}</p></article>",
    f"<main><h1 keep>{MIDDLE}</h1><p keep><a href='/1'>{MIDDLE}</a></p><p keep>{SHORT}</p></main>",
    f"<article><p keep><a href='/1'>{SHORT}</a></p><p keep>{SHORT}</p><p keep><a href='/1'>{WORD}</a></p><p keep><a href='/1'>{LONG}</a></p></article>",
    f"<article><p keep>{LONG}</p><p keep><a href='/1'>{WORD}</a></p></article>", f"<main><p keep>{WORD}</p><p keep><a href='/1'>{SHORT}</a></p></main>",
    f"<div class='page sidebar'><h2 keep>{WORD}</h2><p keep>{LONG}</p><p keep>{LONG}</p></div>",
    f"<body><div class='menu'><a href='/1'>{WORD}</a></div><div class='widget box'><p keep>{LONG}</p><p keep>{LONG}</p></div><div class='ad'>{SHORT}</div></body>",
    # no article is marked: the whole page stands in elements named like parts of the frame, or next to real ones
    f"<body><div class='container sidebar-right'><div><h2 keep>{MIDDLE}</h2><p keep>{LONG}</p><p keep>{LONGER}</p><p keep>{LONG}</p></div></div>"
    f"<div class='menu'><a href='/1'>One</a> <a href='/2'>Two</a></div></body>",
    f"<body><div class='menu'>{SHORT}</div><div class='widget search'><h2 keep>{SHORT}</h2><p keep>{LONGER}</p><p keep>{MIDDLE}</p><p keep>{LONGER}</p>"
    f"<p keep>{LONG}</p></div><div class='sidebar'><a href='/9'>{MIDDLE}</a></div></body>",
    f"<body><div id='header'><div>{SHORT}</div></div><div class='header'><a href='/x'>{SHORT}</a></div><div class='share-box legal'><p keep>{LONGER}</p>"
    f"<p keep>{LONGER}</p><p keep>{LONG}</p></div><div class='legal'>{SHORT}</div><div class='ad'>{SHORT}</div></body>",
    f"<body><div class='promo'>{MIDDLE}</div><div class='ad'>{SHORT}</div><p keep>{LONG}</p><p keep>{LONGER}</p><p keep>{LONG}</p>"
    f"<div class='copyright'>{SHORT}</div><div class='social'>{MIDDLE}</div></body>",
    f"<body><div id='menu'>{SHORT}</div><div><p keep>{LONG}</p><p keep>{LONGER}</p></div><div class='comments'><p>{LONGER}</p><p>{LONGER}</p><p>{LONG}</p></div>"
    f"<div class='copyright'>{SHORT}</div></body>",
    # comments after a marked article
    f"<body>{MENU}<article><p keep>{LONG}</p><p keep>{LONGER}</p></article><div class='sidebar'><p>{LONGER}</p><p>{LONG}</p><p>{LONGER}</p></div>"
    f"<div id='comments'><p>{LONG}</p><p>{LONGER}</p><p>{LONG}</p></div></body>",
    # lines around a page's prose that nothing names: short ones at the edge and between links
    f"<body><div>{SHORT}</div><ul><li><a href='/1'>One</a></li><li><a href='/2'>Two</a></li></ul><div><p keep>{LONG}</p><p keep>{SHORT}</p><p keep>{LONGER}</p>"
    f"<p keep>{MIDDLE}</p><p keep>{LONG}</p></div><ul><li><a href='/3'>Three</a></li></ul><div>{SHORT}</div></body>",
    f"<body><table><tr><td><a href='/1'>One</a></td><td>{SHORT}</td><td><a href='/2'>Two</a></td></tr></table><p keep>{LONGER}</p><p keep>{LONG}</p>"
    f"<p keep>{MIDDLE}</p><div><a href='/4'>{SHORT}</a></div><div>{SHORT}</div></body>",
]
