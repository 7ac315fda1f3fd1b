"""The six-line corpus and the values it must give (see FIXTURES.md)."""

LINES = [
    '<page><title>apple</title><text xml:space="preserve">red fruit red [[banana|b]] [[Banana]] [[Missing]] &lt;b&gt;</text></page>',
    '<page><title>Banana</title><text xml:space="preserve">yellow fruit [[apple#x]] [[cherry]]</text></page>',
    '<page><title>Cherry</title><text xml:space="preserve">red Fruit fruit red red tree</text></page>',
    '<page><title>R&amp;amp;D</title><text xml:space="preserve">[[R&amp;D]] red</text></page>',
    '<page><title>Empty</title><text xml:space="preserve" /></page>',
    '<page><title>R&amp;D</title><text xml:space="preserve">[[Cherry]] fruit red fruit</text></page>',
]

TITLES = ["Apple", "Banana", "Cherry", "R&amp;D", "Empty", "R&D"]

RANKS = [
    ("Cherry", 0.297678806), ("Banana", 0.226474693), ("Apple", 0.174596844),
    ("R&D", 0.144784076), ("Empty", 0.078232791), ("R&amp;D", 0.078232791),
]

FIRST_TURN = {
    "Apple": 0.143055556, "Banana": 0.213888889, "Cherry": 0.284722222,
    "R&amp;D": 0.072222222, "Empty": 0.072222222, "R&D": 0.213888889,
}

POSTINGS = {
    "Banana": "2 1", "D": "5 1", "R": "5 1", "b": "2 2", "fruit": "0 1;1 1;2 1;3 2",
    "red": "0 3;2 2;3 1;5 1", "yellow": "1 1", "Cherry": "3 1", "Fruit": "0 1",
    "amp": "5 1", "banana": "2 1", "gt": "2 1", "tree": "0 1", "Missing": "2 1",
    "apple": "1 1", "cherry": "1 1", "lt": "2 1", "x": "1 1",
}

SEARCHES = {
    ("red", "fruit"): [
        (1, "Cherry", 1, 0.301029996, 0.026975373067),
        (2, "Apple", 1, 0.301029996, 0.015821801553),
        (3, "R&D", 1, 0.301029996, 0.013120196606),
    ],
    ("red",): [
        (1, "Cherry", 3, 0.528273777, 0.083074172076),
        (2, "Apple", 2, 0.352182518, 0.021655687562),
        (3, "R&D", 1, 0.176091259, 0.004489483665),
        (4, "R&amp;D", 1, 0.176091259, 0.002425852659),
    ],
    ("amp", "lt"): [],
    ("absent",): [],
}
