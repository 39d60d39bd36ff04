"""Made-up reply texts. A number is made from the place of its field, so that each field can be told by its value."""

from opticlake import constants as C

PORT, LANES = "et-2/0/9", 3


def value(i):
    return i * 1.25 - 7


#: In the order of the fields; thresholds that are temperatures carry a unit, which does not count.
THRESHOLDS = [value(i) for i in range(len(C.THRESHOLD_TAGS))]
TEMPERATURE, VOLTAGE = 30.5, 3.125


def lane_values(lane):
    """The measures of a lane, in the order of the fields."""
    return [value(40 + 10 * lane + i) for i in range(len(C.LANE_TAGS))]


def element(tag, text, attributes=""):
    return f"<{tag}{attributes}>{text}</{tag}>"


def interface(name, diagnostics):
    return element("physical-interface", element("name", name) + diagnostics)


def optics_reply(*interfaces):
    body = element("interface-information", "".join(interfaces), ' xmlns="urn:information"')
    return element("rpc-reply", body, ' xmlns="urn:reply" xmlns:u="urn:units"')


def _limits():
    return "".join(element(tag, f"{v} degrees" if "temperature" in field else v)
                   for (field, tag), v in zip(C.THRESHOLD_TAGS.items(), THRESHOLDS, strict=True))


def _lane(lane):
    measures = "".join(element(tag, v) for tag, v in zip(C.LANE_TAGS.values(), lane_values(lane), strict=True))
    return element("optics-diagnostics-lane-values", element("lane-index", lane) + measures)


def _body(*parts):
    # The text of the temperature is not the measured value, its attribute is.
    return element("optics-diagnostics", element("module-temperature", "about 99", f' u:celsius="{TEMPERATURE}"')
                   + element("module-voltage", f"{VOLTAGE} V") + "".join(parts))


#: Rx power comes from the tags that stand in for the usual ones: those of the lanes' tx come first, rx follows.
FALLBACKS = dict(zip(["rx-signal-avg-optical-power", "rx-signal-avg-optical-power-dbm"], (value(70), value(71)), strict=True))
SENT = {"laser-bias-current": value(72), "laser-output-power": value(73), "laser-output-power-dbm": value(74)}
WITH_LANES = _body(*map(_lane, range(LANES)), _limits())
WITHOUT_LANES = _body(_limits(), *[element(t, v) for t, v in (FALLBACKS | SENT).items()])

#: A port that is lit, and two that are not: without diagnostics, and with the mark that there are none.
LANED_REPLY = optics_reply(
    interface("et-2/0/8", ""), interface(PORT, WITH_LANES),
    interface("et-2/0/10", element("optics-diagnostics", element("optic-diagnostics-not-available", ""))))
UNLANED_REPLY = optics_reply(interface(PORT, WITHOUT_LANES))


def docs(spark, *texts, rpc="optics_diagnostics"):
    rows = [(f"dev-{i}", rpc, 1700000000, f"/replies/{i}", text) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, "device string, rpc string, run_timestamp long, path string, xml string")
