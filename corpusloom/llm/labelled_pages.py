"""Small hand-labelled pages: html and the blocks of it that are main text."""

PAGES = [
    (
        "<html><head><title>Rain</title></head><body><nav><ul><li><a href='/'>Home</a></li><li><a href='/n'>News"
        "</a></li><li><a href='/c'>Contact us</a></li></ul></nav><div class='ad'>Buy one kettle, get one free.</div>"
        "<article><h1>Rain over the hills</h1><p>It rained for two days and the river rose above its banks before "
        "the mill was closed.</p><p>Soon after.</p><p>The bridge held, people said, because it was built from stone "
        "and not from timber like the old one.</p></article><footer>&copy; Hill News. All rights reserved.</footer>"
        "</body></html>",
        [
            "Rain over the hills",
            "It rained for two days and the river rose above its banks before the mill was closed.",
            "Soon after.",
            "The bridge held, people said, because it was built from stone and not from timber like the old one.",
        ],
    ),
    (
        "<body><header><a href='/'>The Daily Loom</a> <p>Weaving news since long ago</p></header><main><h1>Wool prices"
        "</h1><p>Prices fell.</p><p>Traders met <a href='/m'>at the market</a> on Monday and agreed to wait for the "
        "spring clip before they set a new price.</p><p>Yes.</p><aside><h3>Related</h3><p><a href='/1'>Cotton up again"
        "</a></p><p><a href='/2'>Silk for sale this week only</a></p></aside><p>No one objected.</p></main><footer>"
        "<p>Imprint and contact</p><p><a href='/p'>Privacy</a></p></footer></body>",
        [
            "Wool prices",
            "Prices fell.",
            "Traders met at the market on Monday and agreed to wait for the spring clip before they set a new price.",
            "Yes.",
            "No one objected.",
        ],
    ),
    (
        "<body><div id='cookie-notice'><p>We use cookies to make this site better for you, and we share some of what "
        "we learn with partners who may combine it with other facts.</p></div><article><header><h2>A short walk</h2>"
        "</header><p>We left at dawn and walked along the ridge until noon, when the fog came up from the valley.</p>"
        "<ul><li>Bread</li><li>Two apples</li></ul><section class='comments'><h3>Comments</h3><p>What a fine walk, I "
        "wish that I had been there with you to see the fog come up from the valley below.</p><p>Me too!</p></section>"
        "</article><div class='sidebar'><p>Most read this week in our travel section, chosen by the editors.</p></div>"
        "</body>",
        [
            "A short walk",
            "We left at dawn and walked along the ridge until noon, when the fog came up from the valley.",
            "Bread",
            "Two apples",
        ],
    ),
    (
        "<body><table><tr><td><a href='/a'>Alpha</a></td><td><a href='/b'>Beta</a></td><td><a href='/c'>Gamma</a></td>"
        "</tr></table><h1>Notes on a clock</h1><p>The clock was taken apart on a winter evening and every wheel was "
        "laid on a white cloth in the order in which it came out of the case.</p><p>Nothing was missing, which was "
        "a surprise, since the clock had stood in a barn for forty years and mice had lived in it.</p><p><a href='/1'>"
        "One</a> | <a href='/2'>Two</a> | <a href='/3'>Three</a></p></body>",
        [
            "Notes on a clock",
            "The clock was taken apart on a winter evening and every wheel was laid on a white cloth in the order in "
            "which it came out of the case.",
            "Nothing was missing, which was a surprise, since the clock had stood in a barn for forty years and mice "
            "had lived in it.",
        ],
    ),
    (
        "<body><form action='/s'><p>Search the whole archive of letters and papers by name, place or year</p><input>"
        "</form><div class='post'><h2>Letter one</h2><p>Dear friend, the ship came in on Friday with all the books "
        "that you had sent, and not one of them was wet.</p><blockquote>Keep them dry.</blockquote><p>Thank you."
        "</p></div><div class='promo'><p>Subscribe now and read every letter that we have for a small fee each month, "
        "which you can cancel at any time.</p></div><div>Powered by paper</div></body>",
        [
            "Letter one",
            "Dear friend, the ship came in on Friday with all the books that you had sent, and not one of them was wet.",
            "Keep them dry.",
            "Thank you.",
        ],
    ),
    (
        "<article><p><b>Bold start.<br><p>End.<p>A third paragraph that is somewhat longer than the other two.</article>"
        "<footer>Made by hand and sent by post</footer>",
        ["Bold start.", "End.", "A third paragraph that is somewhat longer than the other two."],
    ),
    (
        "<div role='navigation'><a href='/'>Start</a> <a href='/x'>Index</a></div><div class='content'><p>Salt keeps."
        "</p><p>See <a href='/salt'>the long page about salt and how it was carried over the mountains</a>.</p></div>"
        "<div class='footer'>Terms of use apply to every page of this site and to all that is printed from it.</div>",
        [
            "Salt keeps.",
            "See the long page about salt and how it was carried over the mountains.",
        ],
    ),
    (
        "<p>Issue twelve</p><article><h1>Ink</h1><p>Ink was made from oak galls, iron and gum, and it turned darker "
        "in the weeks after it had been written with.</p><p>It bites.</p><p>Some of the pages have holes where the "
        "letters",
        [
            "Ink",
            "Ink was made from oak galls, iron and gum, and it turned darker in the weeks after it had been written with.",
            "It bites.",
            "Some of the pages have holes where the letters",
        ],
    ),
    (
        "<div>Your weekly paper</div><div>Edition for the north</div><article><h2>Frost</h2><p>Cold.</p></article>"
        "<div>Printed on Monday</div>",
        ["Frost", "Cold."],
    ),
    (
        "<h1>How to sharpen a scythe</h1><p>Hammer the edge thin on a small anvil, then draw a wet stone along it from "
        "heel to point, first on one side and then on the other.</p><p>Stop when a blade of grass falls without "
        "bending, and hang the scythe up where no child can reach it before you go in.</p>",
        [
            "How to sharpen a scythe",
            "Hammer the edge thin on a small anvil, then draw a wet stone along it from heel to point, first on one "
            "side and then on the other.",
            "Stop when a blade of grass falls without bending, and hang the scythe up where no child can reach it "
            "before you go in.",
        ],
    ),
    (
        "<p><a href='/'>Back to the list</a></p><p>Page 3 of 9</p><p>The third part of the report deals with the roads, "
        "which were counted, measured and drawn again in the year of the great snow.</p><p>Last changed in May</p>",
        [
            "The third part of the report deals with the roads, which were counted, measured and drawn again in the "
            "year of the great snow.",
        ],
    ),
    (
        "<article><h1>Links</h1><p><a href='/one'>A first place that is worth a visit</a></p><p><a href='/two'>Another"
        "</a></p></article>",
        ["Links", "A first place that is worth a visit", "Another"],
    ),
    (
        "<body class='single has-sidebar'><div class='site no-banner'><main class='with-header'><article class='post "
        "tags-news'><div class='entry-header'><h1>The ferry</h1></div><p>It crosses twice a day, at seven and at "
        "five, and waits for no one.</p><p>Bring coins.</p><div class='related-posts'><p>Bridges of the lower river, "
        "and how they were paid for by the towns on both banks</p></div></article></main><div class='sidebar-widget'>"
        "<p>Weather for the coast</p></div></div></body>",
        ["The ferry", "It crosses twice a day, at seven and at five, and waits for no one.", "Bring coins."],
    ),
    (
        "<body class='login-open'><form id='page'><div class='layout sidebar'><article><h2>Moss</h2><p>Moss grows on "
        "the north wall, where the sun does not reach it.</p><p>Slowly.</p></article></div><div class='nav-links'><p>"
        "All pages on walls and roofs</p></div></form></body>",
        ["Moss", "Moss grows on the north wall, where the sun does not reach it.", "Slowly."],
    ),
    (
        "<body><article><h1>Oats</h1><p class='advert'>A new oven bakes twice as fast, and this week you pay half of "
        "its price.</p><p>Oats are sown in spring, as soon as the ground is dry enough to be walked on.</p><ul><li>Rye"
        "</li><li class='ad'>Win a mill stone for your garden</li><li>Barley</ul><p>They <span class='sponsored'>Order "
        "flour today</span> ripen late.</p><p class='cookie-notice'>We keep a small file on your machine so that we "
        "know you when you come back.</p><table><tr><td>Acres</td><td>Forty</td></tr><tr class='promo'><td>Seed at "
        "half price until Sunday</td></tr></table></article></body>",
        [
            "Oats",
            "Oats are sown in spring, as soon as the ground is dry enough to be walked on.",
            "Rye",
            "Barley",
            "They ripen late.",
            "Acres Forty",
        ],
    ),
]
