"""Hand-made turns that exercise each rule, added to the tables the queries run over."""

from __future__ import annotations

#: (question, answer, search query, retrieved documents)
TURNS: tuple[tuple[str | None, str | None, str | None, str | None], ...] = (
    ("Where can I find my invoice?", "The request failed while we looked it up.", "refund", "3 docs"),
    ("Where can I find my invoice?", "errorless code, buggy tale.", " ", "0건"),
    ("주문을 취소하려면 어떻게 하나요", "error가 났습니다.", "[]", "[]"),
    ("주문을 취소하려면 어떻게 하나요", "조회 중 오류가 생겼습니다.", "없음", "없음"),
    ("주문을 취소하려면 어떻게 하나요", "주문은 my page 화면에서 취소하세요.", None, None),
    ("주문을 취소하려면 어떻게 하나요", "{{고객}}님, 주문이 취소되었습니다.", "N/A", " 0 docs "),
    ("주문을 취소하려면 어떻게 하나요", "주문 [여기에 입력] 항목을 채우세요.", "주문", "No Results"),
    ("q", "Dear <INSERT_NAME>, see [COMPANY NAME] soon.", "x", "000"),
    ("q", "A link [COMPANY NAME](/home) and [1] and - [ ] box.", "-", "{}"),
    ("q", "```\n{{ code }}\n```\nplain.", "a", "1 docs"),
    ("q", "| 10 | 20 |\n| 30 |", "a", "b"),
    ("q", "| a | b |\n|---|---|\n| 1 | 2 |", "a", "b"),
    ("q", "| a | b |\n| 1 | 2 |", "a", "b"),
    ("q", "| a \\| c | b |\n|---|---|\n| 1 | 2 |\n\n| x |\n|---|\n| y |", "a", "b"),
    ("q", "#heading\ntext.", "a", "b"),
    ("q", "# heading\n####### deep.", "a", "b"),
    ("q", "some **bold text.", "a", "b"),
    ("q", "some `code and ~~strike.", "a", "b"),
    ("q", "a [link](http://a.com and more.\nnext)", "a", "b"),
    ("q", "a [link without end.", "a", "b"),
    ("q", "```python\nif a | b:\n  print('[')\n```\ndone.", "a", "b"),
    ("q", "```\nopen fence | a\n| b", "a", "b"),
    ("q", "line one\\nline two\\nline three.", "a", "b"),
    ("q", "bad \ufffd sign.", "a", "b"),
    ("q", "bell \x07 rings.", "a", "b"),
    ("q", "Write to jane@shop.example for a copy of it.", "a", "b"),
    ("q", "call 010-1234-5678로 or 02.123.4567 now.", "a", "b"),
    ("q", "id 900101-1234567 and 9001011234567.", "a", "b"),
    ("q", "card 4111-1111-1111-1111 and 4111 1111 1111 1112.", "a", "b"),
    ("q", "account 110-123-456789 on 2024-01-15, firm 123-45-67890.", "a", "b"),
    ("q", "passport M12345678 at 192.168.0.1 not 999.1.1.1.", "a", "b"),
    ("q", "api_key = abcdefghijkl123 and https://user:pw@host.com/x", "a", "b"),
    ("q", "+82-10-1234-5678 is mobile.", "a", "b"),
    ("q", "The steps are in the [guide](htp://shop) we sent.", "a", "b"),
    ("q", "See [manual](https://ok.com/a) and http://fine.org, too.", "a", "b"),
    ("q", "See [home](/a) or [top](#x) or http://nohost/ now.", "a", "b"),
    ("q", "See [mail](mailto:a@b.c) or [](  ).", "a", "b"),
    ("q", "See www.python.org for more.", "a", "b"),
    ("q", "See www.example.com or (http://in.paren) here.", "a", "b"),
    ("q", "broken [x](http://a.com", "a", "b"),
    ("q", "<think>never closed", "a", "b"),
    ("q", "<thinking>closed</thinking> fine.", "a", "b"),
    ("q", "I like espresso", "a", "b"),
    ("q", "그런데, ", "a", "b"),
    ("q", "", "a", "b"),
    ("", "", "a", "b"),
    (None, None, None, None),
    ("  ", "\u3000\u2028 ", "''", "null"),
    ("q", "Cut off here...", "a", "b"),
    ("q", "Cut off here…", "a", "b"),
    ("q", "a [Truncated] answer.", "a", "b"),
    ("q", "ends with list\n- item", "a", "b"),
    ("q", "ends with list\r\n2) item", "a", "b"),
    ("q", "no end at all", "a", "b"),
    ("q", "한국어로 끝남", "a", "b"),
    ("q", "이것은 문장입니다", "a", "b"),
    ("q", "정보(참고)", "a", "b"),
    ("q", "open (paren without end", "a", "b"),
    ("q", "ends with comma,", "a", "b"),
    ("q", "1.", "a", "b"),
    ("q", "| a | b |", "a", "b"),
    ("q", "그 정보가 없습니다.", "a", "b"),
    ("q", "해당 내용은 제공되지 않아 알 수 없습니다.", "a", "b"),
    ("q", "한국어 문장에 カナ가 섞였습니다.", "a", "b"),
    ("q", "한국어 문장에 漢字漢字가 섞였습니다 그리고 계속됩니다.", "a", "b"),
    ("q", "한국어 문장(漢字漢字)은 괜찮습니다.", "a", "b"),
    ("표로 정리해줘", "표가 아닙니다.", "a", "b"),
    ("표로 정리해줘", "| a | b |\n| c | d |", "a", "b"),
    ("as a table please", "<table ><tr></tr></table>", "a", "b"),
    ("한 줄로 답해줘", "첫 줄.\n둘째 줄.", "a", "b"),
    ("in one sentence", "Only one.\n\n", "a", "b"),
    ("bullet please", "- a\n- b", "a", "b"),
    ("목록으로", "하나뿐입니다.", "a", "b"),
    ("numbered list", "1. a\n2) b", "a", "b"),
    ("번호를 매겨줘", "- a\n- b", "a", "b"),
    ("json으로 줘", '```json\n{"a": 1}\n```', "a", "b"),
    ("JSON please", "not at all.", "a", "b"),
    ("주문을 취소하려면 어떻게 하나요", "Your invoice is listed under billing in your account.", "a", "b"),
    ("When will it arrive?", "Bạn có thể yêu cầu hoàn tiền.", "a", "b"),
    ("これは何ですか", "这是一个中文的回答。", "a", "b"),
    ("Привет, как дела?", "مرحبا كيف حالك", "a", "b"),
    ("123", "456", "a", "b"),
    ("q", "tab\tand\x0bvt\x0cff\x1cfs\x85nel\u2028ls. done", "a", "b"),
    ("q", "a `code` b ``` inline fence ``` c\n``` x\nd | e\n```\nf.", "a", "b"),
)

#: What documents are asked, so that the format checks run over all of them.
QUESTION = "Answer as a table, in one sentence, as bullets, a numbered list or JSON"
