"""A small HTML tree for the page extractor (standard library only).

End tags close the nearest open tag of that name, void tags hold nothing, and
everything still open is closed at the end, so broken pages give a tree too.
"""

from __future__ import annotations

from html import escape
from html.parser import HTMLParser

# Tags without content, and tags whose text is no page text.
VOID = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source track wbr "
    "basefont bgsound command frame image isindex nextid spacer".split()
)
SILENT = frozenset(("script", "style", "template"))
COMMENT = "[comment]"


class Node:
    """A tag (``name``) or a piece of text (``name`` is None). ``order`` is the
    place in the document; a tag's subtree is ``order .. end``."""

    __slots__ = ("name", "attrs", "text", "kids", "order", "end")

    def __init__(self, name, order, attrs=(), text=""):
        self.name, self.attrs, self.text = name, attrs, text
        self.kids: list[Node] = []
        self.order = self.end = order


class Page(HTMLParser):
    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.nodes: list[Node] = []
        self.root = self._add(None, Node("[page]", 0))
        self._open = [self.root]
        self._run: list[str] = []
        self.feed(html)
        self.close()
        self._end_text()
        for node in self._open:
            node.end = len(self.nodes) - 1

    def _add(self, parent: Node | None, node: Node) -> Node:
        node.order = node.end = len(self.nodes)
        self.nodes.append(node)
        if parent is not None:
            parent.kids.append(node)
        return node

    def _end_text(self):
        if self._run:
            self._add(self._open[-1], Node(None, 0, text="".join(self._run)))
            self._run = []

    def handle_data(self, data):
        self._run.append(data)

    def handle_comment(self, data):
        self._end_text()
        self._add(self._open[-1], Node(COMMENT, 0, text=data))

    def handle_decl(self, data):
        self._end_text()

    handle_pi = unknown_decl = handle_decl

    def handle_starttag(self, tag, attrs):
        self._end_text()
        node = self._add(self._open[-1], Node(tag, 0, attrs))
        if tag not in VOID:
            self._open.append(node)

    def handle_startendtag(self, tag, attrs):
        self._end_text()
        self._add(self._open[-1], Node(tag, 0, attrs))

    def handle_endtag(self, tag):
        self._end_text()
        for depth in range(len(self._open) - 1, 0, -1):
            if self._open[depth].name == tag:
                for node in self._open[depth:]:
                    node.end = len(self.nodes) - 1
                del self._open[depth:]
                return

    # --- look-ups ---

    def inside(self, node: Node, name: str) -> list[Node]:
        """Tags of that name in the subtree, in document order."""
        return [n for n in self.nodes[node.order + 1 : node.end + 1] if n.name == name]

    def first(self, node: Node, name: str) -> Node | None:
        return next((n for n in self.nodes[node.order + 1 : node.end + 1] if n.name == name), None)

    def after(self, node: Node, name: str) -> Node | None:
        """The next tag of that name in the document, inside ``node`` or behind it."""
        return next((n for n in self.nodes[node.order + 1 :] if n.name == name), None)

    @staticmethod
    def children(node: Node, name: str) -> list[Node]:
        return [k for k in node.kids if k.name == name]

    def pieces(self, node: Node) -> list[str]:
        """Text pieces of the subtree, without scripts, styles and comments."""
        if node.name is None:
            return [node.text]
        out: list[str] = []
        stack = [iter(node.kids)]
        while stack:
            kid = next(stack[-1], None)
            if kid is None:
                stack.pop()
            elif kid.name is None:
                out.append(kid.text)
            elif kid.name not in SILENT:
                stack.append(iter(kid.kids))
        return out

    def text(self, node: Node) -> str:
        return "".join(self.pieces(node))

    def joined(self, node: Node, separator: str = "|") -> str:
        stripped = (p.strip() for p in self.pieces(node))
        return separator.join(p for p in stripped if p)

    def markup(self, node: Node) -> str:
        """The subtree as HTML again, with closed tags and plain entities."""
        out: list[str] = []
        stack: list[Node | str] = [node]
        raw = 0
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                raw -= item in ("</script>", "</style>")
                out.append(item)
            elif item.name == COMMENT:
                out.append(f"<!--{item.text}-->")
            elif item.name is None:
                out.append(item.text if raw else escape(item.text, quote=False))
            else:
                attrs = "".join(
                    f" {k}" if v is None else f' {k}="{escape(v, quote=False).replace(chr(34), "&quot;")}"'
                    for k, v in item.attrs
                )
                if item.name in VOID:
                    out.append(f"<{item.name}{attrs}/>")
                    continue
                out.append(f"<{item.name}{attrs}>")
                raw += item.name in ("script", "style")
                stack.append(f"</{item.name}>")
                stack.extend(reversed(item.kids))
        return "".join(out)
