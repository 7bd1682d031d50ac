"""Pages with labels, on which the extraction's model is trained.

Fixed values, written for this purpose.  ``data-main`` marks what an element
and all below it is until another mark: 1 main text, 0 anything else.  ``{s}``,
``{m}`` and ``{l}`` stand for a short, a middling and a long run of text.
"""

HEAD = '<html><head><title>{s}</title><meta name="a" content="b"></head><body data-main="0">'
LINKS = '<ul><li><a href="/a">{s}</a></li><li><a href="/b">{s}</a></li><li><a href="/c">{s}</a></li></ul>'

PAGES = (
    # an article element between menu and footer
    HEAD + "<nav>" + LINKS + '</nav><div class="ad">{m}</div><article data-main="1"><h1>{s}</h1><p><b>{m}<br></b></p>'
    "<p>{l}</p><p>{l}</p><p>{m}</p><p>{s}</p></article><footer>{s} {m}</footer></body></html>",
    HEAD + "<header><h1>{s}</h1><nav>" + LINKS + '</nav></header><main data-main="1"><article><h1>{s}</h1><h2>{s}</h2><p>{l}</p>'
    "<blockquote><p>{m}</p></blockquote><p>{l}</p><ul><li>{m}</li><li>{s}</li></ul><pre>{m}</pre></article></main>"
    '<aside data-main="0"><h3>{s}</h3>' + LINKS + "</aside><footer><p>{s}</p><p>{m}</p>" + LINKS + "</footer></body></html>",
    # named divisions
    HEAD + '<div id="header" class="site-header"><a href="/">{s}</a></div><div id="nav" class="menu navigation">' + LINKS
    + '</div><div id="content" class="content main" data-main="1"><h1 class="title">{s}</h1><div class="post-body entry-content">'
    "<p>{l}</p><p>{m}</p><h2>{s}</h2><p>{l}</p><table><tr><td>{s}</td><td>{s}</td></tr></table></div></div>"
    '<div id="sidebar" class="sidebar"><h3>{s}</h3>' + LINKS + '</div><div id="footer" class="footer">{m}</div></body></html>',
    HEAD + '<div class="cookie-notice banner"><p>{m}</p><button>{s}</button></div><div class="breadcrumb"><a href="/">{s}</a></div>'
    '<div class="article story" data-main="1"><h1>{s}</h1><p>{l}</p><p>{l}</p><div class="advert ad sponsored" data-main="0"><p>{m}</p></div><p>{l}</p></div>'
    '<div class="related-posts widget"><h3>{s}</h3>' + LINKS + "</div></body></html>",
    # comments, forms and sharing beside or inside the article
    HEAD + '<article class="post" data-main="1"><header><h1>{s}</h1></header><p>{l}</p><p>{l}</p>'
    '<div class="share social" data-main="0">' + LINKS + '</div><section class="comments" id="comments" data-main="0"><h3>{s}</h3>'
    '<div class="comment"><p>{m}</p></div><div class="comment reply"><p>{l}</p></div></section></article>'
    '<form class="subscribe newsletter"><label>{s}</label><p>{m}</p><select><option>{s}</option></select></form><footer>{s}</footer></body></html>',
    HEAD + '<nav class="navbar">' + LINKS + '</nav><div class="notice alert"><p>{m}</p></div><main data-main="1"><h1>{s}</h1><p>{l}</p>'
    '<figure><figcaption>{s}</figcaption></figure><p>{m}</p><section><h2>{s}</h2><p>{l}</p><p>{m}</p></section></main>'
    '<section class="comment-list"><ol><li class="comment"><p>{m}</p></li><li class="comment"><p>{l}</p></li></ol></section>'
    '<div class="promo popup"><p>{m}</p></div><footer><p>{m}</p></footer></body></html>',
    # an article with several sections and lists; side matter of long text
    HEAD + '<div class="topbar"><p>{s}</p></div><article data-main="1"><h1>{s}</h1><section><h2>{s}</h2><p>{m}</p><p>{l}</p></section>'
    "<section><h2>{s}</h2><ol><li>{m}</li><li>{m}</li></ol><p>{l}</p></section><div><p>{l}</p><div><p>{m}</p></div></div></article>"
    '<aside class="sidebar ads"><p>{l}</p><p>{m}</p></aside><div class="disqus comments"><p>{l}</p><p>{m}</p></div><footer>{l}</footer></body></html>',
    HEAD + '<header class="banner"><p>{m}</p></header><div class="page wrapper"><div class="nav menu">' + LINKS
    + '</div><div class="main text body" data-main="1"><h1>{s}</h1><p>{m}</p><p>{l}</p><dl><dt>{s}</dt><dd>{m}</dd></dl></div>'
    '<div class="aside related">' + LINKS + '</div></div><div class="footer copyright legal"><p>{m}</p></div><form><p>{m}</p><textarea>{s}</textarea></form></body></html>',
    # other matter inside the article
    HEAD + '<article data-main="1"><p>{m}</p><section class="comments" data-main="0"><p>{s}</p><p>{m}</p></section></article></body></html>',
    HEAD + '<article data-main="1"><h1>{s}</h1><p>{l}</p><div class="comments" data-main="0"><p>{s}</p></div><aside data-main="0"><p>{m}</p></aside></article></body></html>',
    HEAD + '<main data-main="1"><p>{m}</p><nav data-main="0"><p>{s}</p></nav><p>{l}</p><footer data-main="0"><p>{s}</p></footer><ul class="comments" data-main="0"><li>{s}</li><li><p>{m}</p></li></ul></main></body></html>',
    HEAD + '<article data-main="1"><div class="notice" data-main="0"><p>{m}</p></div><p>{l}</p><form data-main="0"><p>{m}</p></form><div class="ad" data-main="0"><p>{m}</p></div><p>{s}</p></article></body></html>',
    HEAD + '<article data-main="1"><header><h1>{s}</h1><p>{m}</p></header><p>{l}</p><section class="related" data-main="0"><p>{s}</p></section><section class="comment" data-main="0"><p>{m}</p></section></article></body></html>',
    # little text
    HEAD + "<nav>" + LINKS + '</nav><article data-main="1"><h1>{s}</h1><p>{s}</p></article><footer>{s}</footer></body></html>',
    HEAD + '<div class="ad">{l}</div><article data-main="1"><p>{s}</p></article><div class="advertisement">{m}</div><footer>{m}</footer></body></html>',
    HEAD + '<article data-main="1">{m}<p>{m}</p>{s}</article><dialog class="consent modal"><p>{m}</p></dialog></body></html>',
    # a site's own header, with a heading that is none of the article's
    HEAD + "<header><h1>{s}</h1></header><article data-main=\"1\"><h1>{s}</h1><p>{l}</p><p>{m}</p></article><footer><p>{s}</p></footer></body></html>",
    HEAD + '<header><h1><a href="/">{s}</a></h1><p>{s}</p></header><nav>' + LINKS + '</nav><main data-main="1"><article><header><h1>{s}</h1></header><p>{l}</p><p>{l}</p></article></main></body></html>',
    HEAD + '<header class="masthead"><h1>{s}</h1><p>{m}</p></header><div class="entry" data-main="1"><h2>{s}</h2><p>{l}</p><p>{l}</p></div><footer><p>{m}</p></footer></body></html>',
    # divisions without names
    HEAD + "<div>" + LINKS + '</div><div data-main="1"><h1>{s}</h1><p>{l}</p><p>{l}</p><p>{m}</p></div><div>' + LINKS + "</div></body></html>",
    HEAD + '<div data-main="1"><p>{l}</p><p>{l}</p></div></body></html>',
    HEAD + '<div><div><a href="/">{s}</a></div><div data-main="1"><p>{l}</p><p>{m}</p><p>{l}</p></div><div><a href="/">{s}</a> <a href="/x">{s}</a></div></div></body></html>',
    HEAD + '<table><tr><td>' + LINKS + '</td><td data-main="1"><h1>{s}</h1><p>{l}</p><p>{l}</p></td></tr></table></body></html>',
    # an encyclopedia
    HEAD + '<div id="mw-head" class="noprint">' + LINKS + '</div><div id="content" class="mw-body"><h1 id="firstHeading" data-main="1">{s}</h1><div id="bodyContent"><div class="mw-parser-output" data-main="1">'
    '<table class="infobox"><tr><th>{s}</th><td>{s}</td></tr></table><p>{l}</p><h2>{s}</h2><p>{l}</p><ul><li><a href="/w">{s}</a> {m}</li><li>{m}</li></ul></div></div></div>'
    '<div id="catlinks">' + LINKS + '</div><div id="footer"><p>{s}</p></div></body></html>',
    HEAD + '<div id="siteSub">{s}</div><div class="mw-parser-output" data-main="1"><p>{l}</p><p>{m}</p><h3>{s}</h3><p>{l}</p></div><div class="printfooter">{s}</div></body></html>',
    # lists, of links too
    HEAD + "<nav>" + LINKS + '</nav><article data-main="1"><h1>{s}</h1><ol><li><a href="/1">{m}</a></li><li><a href="/2">{m}</a></li><li><a href="/3">{m}</a></li></ol></article><footer>{s}</footer></body></html>',
    HEAD + '<main data-main="1"><h1>{s}</h1><ul>' + 24 * '<li><a href="/1">{m}</a></li>' + "</ul></main></body></html>",
    HEAD + '<div id="nav">' + LINKS + '</div><div class="content" data-main="1"><h1>{s}</h1><ul>' + 24 * '<li><a href="/1">{s}</a></li>' + "</ul><p>{s}</p></div><footer>{s}</footer></body></html>",
    HEAD + '<article data-main="1"><h2>{s}</h2><p>{m}</p><ul>' + 24 * '<li><a href="/1">{m}</a></li>' + "</ul></article><aside>" + LINKS + "</aside></body></html>",
    HEAD + '<main data-main="1"><h1>{s}</h1><p>{m}</p><ul><li><a href="/1">{m}</a> {m}</li><li><a href="/2">{m}</a> {m}</li></ul><ul><li>{m}</li><li>{m}</li></ul></main><aside>' + LINKS + "</aside></body></html>",
    HEAD + '<article data-main="1"><h1>{s}</h1><table><tr><th>{s}</th><th>{s}</th></tr><tr><td>{s}</td><td>{m}</td></tr><tr><td>{s}</td><td>{m}</td></tr></table><p>{m}</p></article></body></html>',
    # reader comments under other names
    HEAD + '<article data-main="1"><h1>{s}</h1><p>{l}</p><p>{l}</p></article><div id="respond" class="comment-respond"><h3>{s}</h3><p>{m}</p></div><ol class="commentlist"><li class="comment"><p>{m}</p></li></ol></body></html>',
    HEAD + '<div class="post" data-main="1"><h2>{s}</h2><p>{l}</p><p>{m}</p></div><div id="respond"><p>{m}</p><p>{l}</p></div><div id="disqus_thread"><p>{m}</p></div></body></html>',
    HEAD + '<main data-main="1"><p>{l}</p><p>{l}</p></main><section class="responses replies"><div class="response reply"><p>{l}</p></div><div class="discussion"><p>{m}</p></div></section><div class="feedback reactions"><p>{m}</p></div></body></html>',
    '<html><body data-main="0"><div data-main="1"><p>{l}</p><p>{l}</p></div></body></html>',
    '<html><body data-main="0"><div data-main="1"><p>{l}</p><p>{l}</p><p>{l}</p><p>{l}</p></div><div><p>{s}</p></div></body></html>',
    '<html><body data-main="0"><div><a href="/">{s}</a></div><div data-main="1"><h1>{s}</h1><p>{l}</p><p>{l}</p><p>{m}</p><p>{l}</p></div></body></html>',
    # the first post of a thread
    HEAD + '<div class="board">' + LINKS + '</div><div class="topic thread" data-main="1"><h1>{s}</h1><div class="message post"><p>{l}</p><p>{l}</p></div></div><div class="replies" data-main="0"><div class="reply"><p>{l}</p></div></div></body></html>',
    HEAD + '<div><div data-main="1"><h2>{s}</h2><div><p>{l}</p><p>{m}</p></div></div><div class="answers replies"><div><p>{m}</p></div></div></div></body></html>',
    # no structure but paragraphs
    '<html><body data-main="1"><p>{m}</p></body></html>',
    '<html><body data-main="1"><p>{l}</p></body></html>',
    '<html><head><title>{s}</title></head><body data-main="1"><h1>{s}</h1><p>{m}</p></body></html>',
    "<html><body data-main=\"1\"><h1>{s}</h1><p>{l}</p><p>{m}</p><p>{l}</p></body></html>",
    "<html><body data-main=\"0\"><p data-main=\"1\">{l}</p><p data-main=\"1\">{m}</p><div class=\"footer\">{s}</div></body></html>",
)

RUNS = {
    "s": "a short run of words",
    "m": "this is a sentence of middling length, as it may stand in a notice or in the first lines of a page.",
    "l": " ".join(["this is one of many sentences that together make a long paragraph, as in the body of an article."] * 5),
}


def pages() -> list[str]:
    """The pages as HTML with marks."""
    return [page.format(**RUNS) for page in PAGES]
