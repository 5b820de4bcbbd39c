r"""Ready-made pattern pieces for rules.

Use them inside an ``rf"..."`` rule: ``rf"ip=(?<ip>{PATTERN.IPV4})"``. The ``*_CHARSET`` constants are
bodies of a character class and belong between ``[`` and ``]``.
"""


class PATTERN:
    # Users rely on these names. Of the languages, that of the code location hint is wider, see there.
    UUID = r"[0-9a-fA-F]{8}\-[0-9a-fA-F]{4}\-[0-9a-fA-F]{4}\-[0-9a-fA-F]{4}\-[0-9a-fA-F]{12}"
    # Alternations are kept inside one group, so that they can be followed by other pattern text.
    IP_OCTET = r"((25[0-5])|(2[0-4][0-9])|(1[0-9]{2})|([1-9]{0,1}[0-9]))"
    IPV4 = rf"({IP_OCTET}\.){{3}}{IP_OCTET}"
    PORT = r"\d{1,5}"
    INT = r"\-{0,1}[0-9]+"
    FLOAT = r"\-{0,1}[0-9]+\.[0-9]+"
    LINUX_FILE_NAME_CHARSET = r"a-zA-Z0-9 \._\-"
    LINUX_FILE_NAME = rf"[{LINUX_FILE_NAME_CHARSET}]+"
    LINUX_FILE_PATH = rf"([{LINUX_FILE_NAME_CHARSET}]+/)*{LINUX_FILE_NAME}"
    JAVA_IDENTIFIER_CHARSET = r"a-zA-Z0-9_"
    JAVA_IDENTIFIER = rf"[{JAVA_IDENTIFIER_CHARSET}$]+"
    LOG_LINE_CHARSET = r" \ta-zA-Z0-9\.,:;_\-/\\\[\]\(\)\<\>=\+\*!\?@#$%\^&\|~"
    LOG_LINE = rf"[{LOG_LINE_CHARSET}]+"
    LOG_LINE_NO_WHITE_SPACE_CHARSET = r"a-zA-Z0-9\.,:;_\-/\\\[\]\(\)\<\>=\+\*!\?@#$%\^&\|~"
    LOG_LINE_NO_WHITE_SPACE = rf"[{LOG_LINE_NO_WHITE_SPACE_CHARSET}]+"
    JAVA_LITERAL_CHARSET = r"a-zA-Z0-9_$"
    JAVA_PACKAGE_SEGMENT = rf"[{JAVA_IDENTIFIER_CHARSET}][{JAVA_LITERAL_CHARSET}]*\."
    JAVA_CLASS_NAME = rf"[{JAVA_IDENTIFIER_CHARSET}][{JAVA_LITERAL_CHARSET}]+"
    JAVA_FULLY_QUALIFIED_CLASS_NAME = rf"({JAVA_PACKAGE_SEGMENT})+({JAVA_CLASS_NAME})"
    # The line number and the question mark are both optional, as in "~[?:?]" and "~[Server.java:42]".
    JAVA_LOGGING_CODE_LOCATION_HINT = rf"~\[({LINUX_FILE_NAME}|\?):({INT}){{0,1}}\?{{0,1}}\]"
    JAVA_STACK_LOCATION = (
        rf"{JAVA_FULLY_QUALIFIED_CLASS_NAME}\({LINUX_FILE_NAME}(:{INT}){{0,1}}\)"
        rf"( {JAVA_LOGGING_CODE_LOCATION_HINT}){{0,1}}"
    )
