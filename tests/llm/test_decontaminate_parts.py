from .test_decontaminate import ITEM, leaks


def test_slots_outside_the_part_that_is_there_do_not_count(spark):
    item = ("the old clock in the hall of the inn was sold by its owner to a man called Peter for 40 coins of "
            "silver and some years after that Peter gave it to a friend of his for 40 loaves")
    words = item.split(" ")
    part = words[:15]
    tail = ["other" for _ in words[15:]]
    # where the item has 40 both times, the unrelated text has different numbers
    for at, value in zip([i for i, w in enumerate(words) if w == "40"], ("7", "8"), strict=True):
        tail[at - 15] = value
    assert leaks(spark, [" ".join(part + tail), " ".join(tail), item.replace("for 40 loaves", "for 41 loaves")], [(7, item), (8, ITEM)]) == {0: [(7, True)]}
