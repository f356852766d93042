"""Hand-made mini workbooks with hand-written long rows."""

from midyear.plans.layouts import layout_2000, layout_2011, layout_2016

CELLS = "file string, sheet string, row_idx int, col_idx int, value string"


def grid(file, sheet, *lines):
    return [(file, sheet, i, j, v) for i, line in enumerate(lines, 1)
            for j, v in enumerate(line, 1)]


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_layout_2000(rows):
    cells = grid(
        "/tmp/raw/01 Alta Verapaz.xls", "Población TOTAL",
        ["2000", "Total", None, None, None, None, None, None, None, None],
        [None, "0", None, None, "Cobán", None, "Cobán", "San  Juan", None, None],
        ["Edad", "T", "M", "F", "T", "M", "F", "T", "M", "F"],
        ["0", "9", "4", "5", "2", "1", "1", "7", "3", "4"],
        ["80+", "9", "4", "5", "?", "?", "x", "7", "3.5", "4"],
        ["100", "1", "1", "1", "1", "1", "1", "1", "1", "1"],
        ["2001", None, None, None, None, None, None, None, None, None],
        ["'1", "9", "4", "5", "6", "5", "1", "7", "3", "4"],
        ["nota", None, None, None, None, None, None, None, None, None],
    )
    got = as_set(layout_2000(rows(cells, CELLS)))
    dept = "Alta Verapaz"
    assert got == {
        (2000, dept, "Coban", "male", 0, 1.0), (2000, dept, "Coban", "female", 0, 1.0),
        (2000, dept, "Coban", "male", 80, None), (2000, dept, "Coban", "female", 80, None),
        (2000, dept, "San Juan", "male", 0, 3.0), (2000, dept, "San Juan", "female", 0, 4.0),
        (2000, dept, "San Juan", "male", 80, 3.5), (2000, dept, "San Juan", "female", 80, 4.0),
        (2001, dept, "Coban", "male", 1, 5.0), (2001, dept, "Coban", "female", 1, 1.0),
        (2001, dept, "San Juan", "male", 1, 3.0), (2001, dept, "San Juan", "female", 1, 4.0),
    }


def test_layout_2000_without_first_year(rows):
    cells = grid(
        "/tmp/02 Peten.xls", "Población TOTAL",
        ["Edad", "Total", None, None, None, None, None],
        [None, None, None, None, "Flores", None, None],
        ["x", "T", "M", "F", "T", "M", "F"],
        ["0", "9", "4", "5", "2", "1", "1"],
        ["2001", None, None, None, None, None, None],
        ["0", "9", "4", "5", "4", "2", "2"],
        ["2002", None, None, None, None, None, None],
        ["0", "9", "4", "5", "4", "3", "1"],
    )
    got = {(y, s, p) for y, _, _, s, _, p in as_set(layout_2000(rows(cells, CELLS)))}
    assert got == {(2000, "male", 1.0), (2000, "female", 1.0), (2001, "male", 2.0),
                   (2001, "female", 2.0), (2002, "male", 3.0), (2002, "female", 1.0)}


def sheet_2011(file, sheet, skip, names):
    title = [["Proyecciones"] + [None] * len(names)] * skip
    body = [["Sexo", *names], ["Hombres"] + [None] * len(names), ["0", "1", "2"], ["80+", "?", "3"],
            [None, None, None], ["Mujeres"] + [None] * len(names), ["0", "4", "5"]]
    return grid(file, sheet, *title, *body)


def test_layout_2011(rows):
    cells = (
        sheet_2011("/tmp/11 Santa Rosa.xls", "2012", 4, ["Cuilapa", None])
        + sheet_2011("/tmp/11 Santa Rosa.xls", "Hoja3", 3, ["Cuilapa", "X__1"])
        + sheet_2011("/tmp/11 Santa Rosa (1).xls", "2012", 4, ["Cuilapa", None])
        + sheet_2011("/tmp/05 Escuintla.xls", "2015", 3, ["La  Démocracia", None])
    )
    got = as_set(layout_2011(rows(cells, CELLS)))

    def expected(year, dept, first, second):
        return {
            (year, dept, first, "male", 0, 1.0), (year, dept, second, "male", 0, 2.0),
            (year, dept, first, "male", 80, None), (year, dept, second, "male", 80, 3.0),
            (year, dept, first, "female", 0, 4.0), (year, dept, second, "female", 0, 5.0)}

    # A made-up header name is lowered and title-cased before it is tested.
    assert got == (expected(2012, "Santa Rosa", "Cuilapa", "Nueva Santa Rosa")
                   | expected(2013, "Santa Rosa", "Cuilapa", "Nueva Santa Rosa")
                   | expected(2015, "Escuintla", "La Democracia", None))


def test_layout_2016(rows):
    def sheet(name):
        return grid(
            "/tmp/2016-2020.xlsx", name,
            ["t"] + [None] * 6, ["t"] + [None] * 6, ["t"] + [None] * 6,
            ["Departamento y\nMunicipio", "Total", None, "Menores de 1 año", None, "Total", "Otro"],
            [None, "2016", "2017", "2016", "2017", "2016", "2016"],
            [None] * 7,
            ["Zacapa", "9", "9", "9", "9", "9", "9"],
            ["Villa Nueva", "1", "-", "7", "7", "8", "5"],
            ["Mixco", "3", "4", "7", "7", "8", "6"],
            [None] * 7,
            [None] * 7,
            ["Peten", "9", "9", "9", "9", "9", "9"],
            ["Flores", "5", "6", "7", "7", "8", "x"],
        )

    cells = sheet("Total") + sheet("Hombres")
    got = as_set(layout_2016(rows(cells, CELLS)))
    want = set()
    for sex in ("all", "male"):
        want |= {
            (sex, "total", 2016, "Zacapa", "Villa Nueva", 1.0),
            (sex, "total", 2017, "Zacapa", "Villa Nueva", None),
            (sex, "total", 2016, "Zacapa", "Mixco", 3.0),
            (sex, "total", 2017, "Zacapa", "Mixco", 4.0),
            (sex, "total", 2016, "Peten", "Flores", 5.0),
            (sex, "total", 2017, "Peten", "Flores", 6.0),
            (sex, "otro", 2016, "Zacapa", "Villa Nueva", 5.0),
            (sex, "otro", 2016, "Zacapa", "Mixco", 6.0),
            (sex, "otro", 2016, "Peten", "Flores", None),
        }
    assert got == want
