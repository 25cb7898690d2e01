"""Suffix arrays by Lyndon groups, in linear time and without recursion.

The first phase starts from groups by first symbol and goes through the groups in descending
order. Each suffix of the group points to the nearest suffix on its left that is in a lower group.
Suffixes pointed to leave their group for a new one just above it, by how many pointers they got,
as their common prefix has grown by so many copies of the current group's. In the end a group
holds the suffixes with one Lyndon prefix. The second phase goes through the suffix array from its
smallest entry and puts the suffix on the left of each entry, and those its pointers lead to, at
the front of their groups.
"""

from __future__ import annotations


def suffix_array(symbols: list[int]) -> list[int]:
    """Starts of the suffixes in ascending order. The last symbol must be smaller than all others."""
    n = len(symbols)
    if n < 2:
        return list(range(n))
    # Groups by first symbol; a group is named by the place of its first member.
    members = sorted(range(n), key=symbols.__getitem__)
    place, group, count = [0] * n, [0] * n, [0] * n
    start, last = 0, symbols[members[0]]
    for k, i in enumerate(members):
        if symbols[i] != last:
            start, last = k, symbols[i]
        place[i], group[i] = k, start
        count[start] += 1
    before = [-1] * n

    end = n
    while end:
        start = group[members[end - 1]]
        if end - start == 1:
            # A group of one: at most one suffix is pointed to.
            i = members[start]
            j = i - 1
            while j >= 0 and group[j] > start:
                j = before[j]
            before[i] = j
            if j >= 0:
                old = group[j]
                many = count[old]
                if many > 1:
                    count[old] = many - 1
                    top, at = old + many - 1, place[j]
                    other = members[top]
                    members[at], members[top] = other, j
                    place[other], place[j] = at, top
                    group[j] = top
                    count[top] = 1
            end = start
            continue
        pointers: dict[int, int] = {}
        for i in sorted(members[start:end]):
            j = i - 1
            while j >= 0 and group[j] >= start:
                j = before[j]
            before[i] = j
            if j >= 0:
                pointers[j] = pointers.get(j, 0) + 1
        # By number of pointers, most first, and by group: these leave together.
        leave: dict[tuple[int, int], list[int]] = {}
        for j, many in pointers.items():
            leave.setdefault((-many, group[j]), []).append(j)
        for (_, old), out in sorted(leave.items()) if len(leave) > 1 else leave.items():
            many = count[old]
            if len(out) == many:
                continue
            top = old + many
            for j in out:
                top -= 1
                at = place[j]
                other = members[top]
                members[at], members[top] = other, j
                place[other], place[j] = at, top
            for j in out:
                group[j] = top
            count[old] = many - len(out)
            count[top] = len(out)
        end = start

    free = list(range(n))  # the first open place of each group, by its name
    put = [False] * n
    out = [0] * n
    out[0] = n - 1
    put[n - 1] = True
    for k in range(n):
        j = out[k] - 1
        while j >= 0 and not put[j]:
            name = group[j]
            out[free[name]] = j
            free[name] += 1
            put[j] = True
            j = before[j]
    return out
