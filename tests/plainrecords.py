"""Readers of single records, one field after the other, to hold the columnar ones against."""

from millrace.model import ATOMIC, RAW
from millrace.sources.codecs import THRIFT_IDS


class Avro:
    """Cursor over one schemaless datum."""

    def __init__(self, data):
        self.data, self.at = data, 0

    def take(self, size):
        if size < 0 or self.at + size > len(self.data):
            raise ValueError("message ends early")
        self.at += size
        return self.data[self.at - size : self.at]

    def long(self):
        shift = value = 0
        while True:
            byte = self.take(1)[0]
            value |= (byte & 127) << shift
            shift += 7
            if value >= 2**64 or shift > 70 or (shift == 70 and byte > 1):
                raise ValueError("number is too long")
            if byte < 128:
                return (value >> 1) ^ -(value & 1)

    def bytes(self):
        return self.take(self.long())

    def text(self):
        return self.bytes().decode("utf-8")

    def pair(self):
        return {"schema": self.text(), "data": self.text()}

    def array(self, read):
        items = []
        while count := self.long():
            if count < 0:
                count = -count
                self.long()
            if count > len(self.data):
                raise ValueError("array is longer than the message")
            items += [read() for _ in range(count)]
        return items

    def field(self, name, is_long, nullable):
        read = {"body": self.bytes, "headers": lambda: self.array(self.text), "contexts": lambda: self.array(self.pair), "event": self.pair}.get(name, self.long if is_long else self.text)
        if not nullable:
            return read()
        branch = self.long()
        if branch not in (0, 1):
            raise ValueError("unknown union branch")
        return read() if branch else None


def read_avro(data, schema=RAW):
    cursor = Avro(data)
    return {f.name: cursor.field(f.name, f.dataType.simpleString() == "bigint", f.nullable and (f.name, schema) not in (("contexts", ATOMIC), ("event", ATOMIC))) for f in schema}


def read_thrift(data):
    names = {number: name for name, number in THRIFT_IDS.items()}
    sizes = {2: 1, 3: 1, 4: 8, 6: 2, 8: 4, 10: 8}
    cursor = Avro(data)
    number = lambda n: int.from_bytes(cursor.take(n), "big", signed=True)
    record = {f.name: None for f in RAW}
    while kind := number(1):
        name = names.get(number(2))
        if name and kind != {"timestamp": 10, "headers": 15}.get(name, 11):
            raise ValueError("unexpected type")
        if kind == 11:
            found = cursor.take(number(4))
        elif kind in sizes:
            found = number(sizes[kind])
        elif kind in (14, 15):
            item, count = number(1), number(4)
            if count < 0 or count > len(data) or count and item != 11 and (item not in sizes or name):
                raise ValueError("unexpected list")
            found = [cursor.take(number(4)) if item == 11 else number(sizes[item]) for _ in range(count)]
        else:
            raise ValueError("unexpected field type")
        if name:
            record[name] = found
    for name, found in record.items():  # of a field that is sent twice only the last is looked at
        if isinstance(found, list):
            record[name] = [f.decode("utf-8") for f in found]
        elif isinstance(found, bytes) and name != "body":
            record[name] = found.decode("utf-8")
    if any(record[f.name] is None for f in RAW if not f.nullable):
        raise ValueError("missing")
    return record
