"""Hand-written pages whose names of classes and ids tell nothing, and their main text."""

A = "The council voted on Tuesday to rebuild the old bridge, which has been closed since a flood damaged its central pier, and set aside money for the first phase."
B = "Work should begin in the spring, an engineer said, although the plans still need the approval of the county and of two landowners on the northern bank."
C = "Until then, drivers will have to use the road by the mill, where traffic has doubled and repairs were made twice this winter."
D = "Bake the loaves for forty minutes, turn them once, and let them cool on a rack before you cut them, or the crumb will be gummy."
E = "Mix the flour, the water and the salt in a large bowl; cover it, and leave it alone for at least an hour."
F = "She had not meant to stay, but the rain came down from the hills so quickly that the path was gone before she reached the gate."
G = "The team measured the glacier from the air for nine years, and found that it lost more ice in the last two than in all the others together."
H = "Nobody expected the second half to be any better, and yet, within ten minutes, the visitors had scored twice."
LINKS = "<ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li><li><a href=/a>Archive</a></li><li><a href=/c>Contact</a></li></ul>"
FOOT = "Copyright 2021 The Valley Paper. All rights reserved."

#: (page, main text)
PAGES = [
    (f'<div class="c-7f3"><p>{A}</p><p>{B}</p></div><div class="zz9">{LINKS}</div>', f"{A} {B}"),
    (f'<div class="zz9">{LINKS}</div><div class="c-7f3"><p>{A}</p><p>{B}</p></div>', f"{A} {B}"),
    (f'<div class="story-wrap"><h2>Bridge to be rebuilt</h2><p>{A}</p><div class="x1">{B}</div><p>{C}</p></div>', f"Bridge to be rebuilt {A} {B} {C}"),
    (f"<table><tr><td><a href=/>Home</a><br><a href=/n>News</a></td><td><h1>Bridge to be rebuilt</h1><p>{A}</p><p>{B}</p></td></tr></table>", f"Bridge to be rebuilt {A} {B}"),
    (f"<table><tr><td colspan=2>{LINKS}</td></tr><tr><td>{LINKS}</td><td><p>{F}</p><p>{A}</p></td></tr></table>", f"{F} {A}"),
    (f'<div id="k1">{LINKS}</div><div id="k2"><h1>Country bread</h1><p>{E}</p><p>{D}</p></div><div id="k3">{FOOT}</div>', f"Country bread {E} {D}"),
    (f'<div class="a1"><div class="b2"><div class="c3"><p>{G}</p><p>{H}</p></div></div></div><div class="d4"><p>{FOOT}</p></div>', f"{G} {H}"),
    (f'<div class="css-1a2b3c"><h1>A wet walk</h1><p>{F}</p><p>{A}</p><p>{B}</p></div><div class="css-99aa"><form action=/s><label>Email</label><input><button>Subscribe</button></form></div>', f"A wet walk {F} {A} {B}"),
    (f'<div class="q"><p>We use cookies.</p><button>Accept</button></div><div class="r"><p>{A}</p><p>{C}</p></div>', f"{A} {C}"),
    (f'<div class="u7"><h1>Ice</h1><p>{G}</p><p>{B}</p></div><div class="u8"><h3>Related</h3>{LINKS}</div><div class="u9">{FOOT}</div>', f"Ice {G} {B}"),
    (f"<div><div>{LINKS}</div><div><p>{D}</p><p>{E}</p><p>{F}</p></div></div>", f"{D} {E} {F}"),
    (f'<section class="m1"><p>{H}</p><p>{G}</p></section><section class="m2"><h3>Comments</h3><div class="m3"><b>Ann</b> <span>says</span><p>Great article, thank you.</p><a href=#>Reply</a></div><div class="m3"><b>Bob</b> <span>says</span><p>I was there too.</p><a href=#>Reply</a></div></section>', f"{H} {G}"),
    (f'<div class="n-0f">{LINKS}</div><div class="n-1f"><p>{A}</p><ul><li>two lanes, one for bicycles</li><li>a new central pier</li><li>lights on both sides</li></ul><p>{B}</p></div>', f"{A} two lanes, one for bicycles a new central pier lights on both sides {B}"),
    (f'<div class="jx"><blockquote>{F}</blockquote><p>{G}</p><p>{H}</p></div><div class="jy"><a href=#>Share</a> <a href=#>Tweet</a> <a href=#>Print</a></div>', f"{F} {G} {H}"),
    (f'<div id="w9"><form><input><button>Search</button></form></div><div id="w10"><h1>Second half</h1><p>{H}</p><p>{C}</p></div>', f"Second half {H} {C}"),
    (f'<p class="t0"><a href=/>Home</a> | <a href=/n>News</a> | <a href=/l>Login</a></p><div class="t1"><h2>Dough</h2><p>{E}</p><h2>Oven</h2><p>{D}</p></div>', f"Dough {E} Oven {D}"),
    (f'<div class="v v2"><div class="v3"><p>{A}</p></div><div class="v3"><p>{B}</p></div><div class="v3"><p>{C}</p></div></div><div class="v4">{LINKS}<p>{FOOT}</p></div>', f"{A} {B} {C}"),
    (f'<div class="pp"><div class="po">{G}</div><div class="po">{F}</div></div><div class="pq"><a href=/1>Read more</a><a href=/2>Popular</a><a href=/3>Latest</a></div>', f"{G} {F}"),
    (f'<main><div class="x9"><p>{A} <a href="/m">The mill</a> is near.</p><p>{C}</p></div></main><div class="x8">{LINKS}</div>', f"{A} The mill is near. {C}"),
    (f'<div class="z1">Advertisement <a href=#>Buy now</a></div><div class="z2"><h1>Bread</h1><p>{D}</p><p>{E}</p></div><div class="z1">Advertisement <a href=#>Click here</a></div>', f"Bread {D} {E}"),
    (f'<div class="g5">{LINKS}</div><div class="g6"><pre>{H}</pre><p>{G}</p></div><div class="g7"><p>Privacy | Terms | Imprint</p><p>{FOOT}</p></div>', f"{H} {G}"),
    (f"<div>{LINKS}</div><h1>Bridge to be rebuilt</h1><p>{A}</p><p>{B}</p><p>{C}</p><div>{FOOT}</div>", f"Bridge to be rebuilt {A} {B} {C}"),
]
