"""Plain Python forms of text functions, for small inputs."""


def hide(address: str, key: int) -> str:
    return f"{key:02x}" + "".join(f"{ord(c) ^ key:02x}" for c in address)


def chunks(text: str, size: int, most: int = 24) -> list[str]:
    if len(text) <= size:
        return [text]
    lines = text.split("\n")
    table = len(lines) >= 3 and all(sum(c in ",\t" for c in line) >= 2 for line in lines[:2])
    header, body = (lines[0], lines[1:]) if table else ("", lines)
    out, held, used = [], [], len(header)
    for line in body:
        if held and used + len(line) > size:
            out.append(held)
            held, used = [], len(header)
        held.append(line)
        used += len(line) + 1
    out += [held] if held else []
    return ["\n".join([header, *c] if header else c) for c in out][:most]
