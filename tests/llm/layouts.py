"""Pages written by hand, of kinds the generator has no plan for; ``data-main`` marks main text (1) and anything else (0)."""

PAGES = [
    # forum thread: the opening post is the article, replies are comments
    """<body><div class="forumbar"><a href=/>Boards</a> <a href=/new>New posts</a></div><div class="firstpost" data-main="1"><h2>How I restored a pedal organ</h2><p>The bellows were torn in two places, so I began there.</p><p>Hide glue and thin leather did the job.</p></div><div class="reply"><p>Nice work, which leather?</p></div><div class="reply"><p>Following this.</p></div></body>""",
    # encyclopedia with contents box
    """<body><div id="mw-head"><a href=a>Read</a> <a href=b>Edit</a> <a href=c>History</a></div><div id="bodyContent"><h1 data-main="1">Sundew</h1><p data-main="1">The sundew is a plant that catches insects with sticky hairs.</p><div id="toc"><h2>Contents</h2><ul><li><a href=#1>Habitat</a></li><li><a href=#2>Diet</a></li></ul></div><h2 data-main="1">Habitat</h2><p data-main="1">It grows on wet and poor soil across the northern half of the world.</p><h2 data-main="1">Diet</h2><p data-main="1">Small flies are its usual food.</p></div><div id="footer"><ul><li>Text is available under a free licence.</li></ul></div></body>""",
    # recipe with lists
    """<main><header><a href=/>Kitchen table</a></header><div itemtype="Recipe" data-main="1"><h1>Rye bread</h1><ul><li>500 g rye flour</li><li>10 g salt</li><li>400 ml water</li></ul><ol><li>Mix everything in the evening.</li><li>Bake for an hour in the morning.</li></ol></div><div class="ad-slot"><p>Knives at half the price this week only.</p></div><div id="respond"><h3>Leave a reply</h3><form><label>Name</label><button>Post</button></form></div></main>""",
    # documentation with side tree
    """<div class="layout"><div class="sidebar-tree"><ul><li><a href=1>Start</a><ul><li><a href=2>Install</a></li></ul></li></ul></div><div class="doc-content" data-main="1"><h1>Command line</h1><p>Every command takes a file and writes to the standard output.</p><pre>tool sort names.txt</pre><p>Exit codes other than zero mean failure.</p></div><div class="pager"><a href=p>Previous</a> <a href=n>Next</a></div></div>""",
    # poem
    """<body><nav><a href=/>Poems</a></nav><article data-main="1"><h1>Harbour</h1><p>Grey boats at rest,<br>grey gulls above,<br>and one lamp lit.</p><p>The tide comes in<br>without a word.</p></article><footer>Printed with leave of the estate.</footer></body>""",
    # question and answer
    """<body><div class="topbar"><form><input placeholder=Search><button>Search</button></form></div><div class="question-page" data-main="1"><h1>Why does bread go stale?</h1><p>I keep it in a bag, but after two days it is dry.</p><div class="answer"><p>The starch turns back to crystals. Warmth undoes that for a while.</p></div></div><div class="sidebar"><h4>Linked</h4><a href=1>Why does cake stay moist?</a></div></body>""",
    # faq by definition list
    """<body><ul id="nav"><li><a href=a>Home</a></li><li><a href=b>Shop</a></li></ul><section class="main" data-main="1"><h1>Questions</h1><dl><dt>When do you open?</dt><dd>At nine on weekdays and at ten on Saturdays.</dd><dt>Do you repair bells?</dt><dd>Yes, if you bring them in.</dd></dl></section><div class="footer-links"><a href=x>Imprint</a></div></body>""",
    # press release
    """<body><div class="header-logo"><a href=/>Northern Rail</a></div><div class="press" data-main="1"><h1>New timetable from December</h1><p>Northern Rail will run twelve more trains a day between the two towns.</p><p>Tickets bought before the change stay valid.</p></div><div class="contact-form"><h3>Press contact</h3><form><input><button>Write to us</button></form></div><div class="social-links"><a href=1>Follow us</a></div></body>""",
    # live blog
    """<body><nav class="global"><a href=a>News</a><a href=b>Weather</a></nav><div class="liveblog" data-main="1"><h1>Storm: as it happened</h1><h3>14:05</h3><p>The ferry company has stopped all sailings for the day.</p><h3>13:20</h3><p>A tree is down across the coast road, and police ask drivers to turn back.</p></div><aside class="most-read"><h3>Most read</h3><ol><li><a href=1>Ferry strike ends</a></li></ol></aside></body>""",
    # Chinese
    """<body><div class="nav"><a href=a>首页</a> <a href=b>新闻</a></div><div class="article-body" data-main="1"><h1>春天的山路</h1><p>早上下了一点小雨，山路上没有什么人。</p><p>走到半山，太阳出来了，远处的湖面闪着光。</p></div><div class="comments"><p>写得真好！</p></div><div class="footer">版权所有</div></body>""",
    # Arabic
    """<html dir=rtl><body><ul class="menu"><li><a href=a>الرئيسية</a></li><li><a href=b>اتصل بنا</a></li></ul><article data-main="1"><h1>سوق السمك</h1><p>يفتح السوق قبل الفجر، ويأتي الصيادون بما جمعوه في الليل.</p><p>عند الظهر لا يبقى شيء.</p></article><footer><p>جميع الحقوق محفوظة</p></footer></body></html>""",
    # Greek, div soup without any telling name
    """<body><div class="c1"><a href=a>Αρχική</a> <a href=b>Επικοινωνία</a></div><div class="c2" data-main="1"><h1>Το φεγγάρι</h1><p>Χθες το βράδυ το φεγγάρι ήταν γεμάτο και φώτιζε όλο τον κάμπο.</p><p>Οι σκύλοι δεν σταμάτησαν να γαβγίζουν.</p></div><div class="c3"><a href=c>Όροι χρήσης</a></div></body>""",
    # product description
    """<body><div class="breadcrumbs"><a href=a>Tools</a> &gt; <a href=b>Saws</a></div><div class="product-description" data-main="1"><h1>Bow saw, 24 inch</h1><p>A light saw for green wood, with a blade that can be turned.</p><ul><li>Hardened teeth</li><li>Beech handle</li></ul></div><div class="recommended"><h3>Customers also bought</h3><ul><li><a href=1>Spare blade</a></li><li><a href=2>Work gloves</a></li></ul></div></body>""",
    # changelog
    """<body><header><a href=/>libfoo</a></header><main data-main="1"><h1>Changes</h1><h2>2.1</h2><ul><li>Reading is twice as fast.</li><li>The old format is refused.</li></ul><h2>2.0</h2><ul><li>First stable release.</li></ul></main><footer><a href=/feed>Feed</a></footer></body>""",
    # interview
    """<body><div class="cookie-notice"><p>We use cookies to count our readers.</p><button>Fine</button></div><div class="text" data-main="1"><h1>"I never learned to read notes"</h1><p><b>You began at forty. Why so late?</b></p><p>There was no piano before that. Then a neighbour moved away and left hers.</p><p><b>Do you practise daily?</b></p><p>No.</p></div><div class="newsletter-signup"><p>Our best texts every Friday.</p></div></body>""",
    # abstract
    """<body><nav class="toolbar"><a href=a>PDF</a> <a href=b>Cite</a></nav><div id="abstract" data-main="1"><h1>Heat loss in small mammals</h1><p>We measured how fast shrews cool at rest. Heat loss rises with the surface and falls with the fur's depth.</p></div><div class="related-papers"><h4>Similar papers</h4><ul><li><a href=1>Fur depth in voles</a></li></ul></div></body>""",
    # job advert as main text
    """<body><div class="masthead"><a href=/>Town hall</a></div><section class="vacancy" data-main="1"><h1>Gardener wanted</h1><p>We look for a gardener for the two parks by the station.</p><h3>Your work</h3><ul><li>Care of trees and beds</li><li>Winter service</li></ul><p>Apply by the end of March.</p></section><form><h4>Apply here</h4><label>Your name</label><button>Send</button></form></body>""",
    # statute
    """<body><div id="top"><a href=/>Law reports</a></div><div id="content" data-main="1"><h1>Footpaths Act</h1><h3>Section 1</h3><p>(1) A footpath stays open to all unless a court orders otherwise.</p><p>(2) The order has to be posted at both ends.</p><h3>Section 2</h3><p>Owners may fit gates.</p></div><div id="bottom"><a href=/t>Terms of use</a></div></body>""",
    # weather report
    """<body><nav><ul><li><a href=a>Today</a></li><li><a href=b>Week</a></li></ul></nav><div class="report" data-main="1"><h2>Outlook</h2><p>Dry at first, then rain from the west. Winds stay light.</p><table><tr><th>Day</th><th>High</th></tr><tr><td>Monday</td><td>12</td></tr><tr><td>Tuesday</td><td>9</td></tr></table></div><div class="banner"><p>Umbrellas of every colour, order today.</p></div></body>""",
    # blog, archive widget before the text
    """<body><div class="widget-area"><h4>Archive</h4><ul><li><a href=1>May</a></li><li><a href=2>April</a></li></ul></div><div class="hentry" data-main="1"><h2>Moving bees</h2><p>Hives are moved at night, when all bees are home.</p><p>We closed the doors with foam and drove slowly.</p></div><div id="comments"><p>What about ventilation?</p><p>Mesh on top, I guess.</p></div></body>""",
    # table layout of the nineties
    """<body bgcolor=white><table><tr><td colspan=2><font size=1><a href=a>Home</a> | <a href=b>Guestbook</a></font></td></tr><tr><td><font size=1><a href=c>Links</a></font></td><td data-main="1"><h2>My model railway</h2><p>The line runs once around the attic. Two trains can pass at the station.</p><p>All houses are made of card.</td></tr></table></body>""",
    # obituary
    """<body><div class="site-nav"><a href=a>News</a><a href=b>Notices</a></div><div class="story" data-main="1"><h1>Anna Berg, bell founder</h1><p>Anna Berg, who cast more than two hundred bells, has died aged ninety-one.</p><p>She kept working until last spring.</p></div><div class="condolences comments"><p>A great loss to us all.</p></div></body>""",
    # event page
    """<body><header class="top"><nav><a href=a>Programme</a><a href=b>Tickets</a></nav></header><div class="event" data-main="1"><h1>Night of the libraries</h1><p>All branches stay open until midnight.</p><p>There are readings for children from six.</p></div><div class="share"><a href=1>Share</a><a href=2>Print</a></div><footer>City library, 12 Market Square</footer></body>""",
    # figure captions and sections of a photo essay
    """<article><header><div class="byline"><a href=x>By the photo desk</a></div></header><div class="essay" data-main="1"><h1>Salt</h1><figure><img src=1><figcaption>Workers rake the pans at dawn.</figcaption></figure><p>The season lasts from June to September.</p><figure><img src=2><figcaption>Each pile weighs a ton.</figcaption></figure></div><aside><p>Subscribe for more photo essays.</p></aside></article>""",
    # one paragraph only
    """<body><nav><a href=a>Home</a></nav><p data-main="1">The office is closed until the second of January because of the move to the new building.</p><footer>&copy; the office</footer></body>""",
    # lesson with exercises
    """<body><div class="course-nav"><a href=1>Lesson 1</a> <a href=2>Lesson 2</a></div><div class="lesson" data-main="1"><h1>Fractions</h1><p>A fraction names a part of a whole. The lower number says into how many parts the whole is cut.</p><h3>Exercises</h3><ol><li>Write one half as a sum of two equal fractions.</li><li>Which is larger, two thirds or three quarters?</li></ol></div><div class="ads"><p>Find a tutor near you.</p></div></body>""",
    # letter to the editor with quoted text
    """<body><div id="masthead"><a href=/>Evening Post</a></div><div class="letter" data-main="1"><h2>On the new bus stop</h2><p>Sir, the new bus stop stands where no one lives.</p><blockquote>It will serve the growing suburb.</blockquote><p>So said the council. Which suburb?</p></div><div class="footer"><p>Letters may be shortened.</p></div></body>""",
    # nested wrappers, main text deep inside
    """<body><div class="wrap"><div class="inner"><div class="row"><div class="col-3 left-nav"><ul><li><a href=a>Rivers</a></li><li><a href=b>Lakes</a></li></ul></div><div class="col-9"><div class="richtext" data-main="1"><h1>The upper river</h1><p>The river rises in a bog and falls over three steps.</p><p>Trout live above the falls, pike below.</p></div></div></div></div></div></body>""",
    # advert inside the text
    """<body><article><h1 data-main="1">Early frost</h1><p data-main="1">Frost came three weeks early and took most of the pears.</p><div class="advert-inline"><p>Warm boots for the whole family, now in stock.</p></div><p data-main="1">Apples fared better, as they had mostly been picked.</p></article><div class="sponsored-content"><p>This one trick saves your garden.</p></div></body>""",
    # comments in an ordered list under article, without the word
    """<body><nav><a href=1>Index</a></nav><article data-main="1"><h1>Two kinds of clover</h1><p>White clover creeps, red clover stands.</p><p>Bees like both.</p></article><section class="discussion"><ol><li><p>Cows too.</p></li><li><p>Mine is pink.</p></li></ol></section></body>""",
    # Russian, main element
    """<body><header><a href=a>Главная</a> <a href=b>О нас</a></header><main data-main="1"><h1>Старая мельница</h1><p>Мельница стоит на реке уже двести лет, и колесо всё ещё крутится.</p><p>Зимой её закрывают.</p></main><footer>Все права защищены</footer></body>""",
    # Japanese, unnamed blocks
    """<body><ul><li><a href=a>トップ</a></li><li><a href=b>一覧</a></li></ul><section data-main="1"><h2>港の朝</h2><p>朝の港は静かで、船がゆっくりと戻ってくる。</p><p>市場は六時に開く。</p></section><div class="pagetop"><a href=#>上へ</a></div></body>""",
    # glossary as a table
    """<body><nav class="crumbs"><a href=a>Sailing</a></nav><div class="page-content" data-main="1"><h1>Words of the deck</h1><table><tr><td>Sheet</td><td>A rope that holds a sail's lower corner.</td></tr><tr><td>Stay</td><td>A wire that holds the mast.</td></tr></table></div><div class="sidebar-right"><h4>Books</h4><a href=1>Knots for all</a></div></body>""",
    # login box and alert before the text
    """<body><div class="alert"><p>Your browser is out of date.</p></div><form class="login"><label>User</label><input><button>Log in</button></form><div class="post" data-main="1"><h1>Notes on tuning</h1><p>Start from the middle and go outwards by fifths.</p><p>Check the octaves last.</p></div><div class="pagination"><a href=1>1</a> <a href=2>2</a></div></body>""",
]
