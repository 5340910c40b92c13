"""Prompt texts.  Fixed values: recorded answers are only valid for these exact prompts."""

from __future__ import annotations

from tagloom.functions.lexicon import CATEGORIES

LABEL_LINES = "\n".join(f"- {label}" for label in sorted(CATEGORIES))

TITLE_PROMPT = f"""\
당신은 VOC 제목을 아래 카테고리 중 하나로만 분류하는 분류기입니다.
카테고리 목록:
{LABEL_LINES}

카테고리 분류 기준:
- 반응_교환: [교환] 태그, 교환 요청, 사이즈 교환, 교환 구해요
- 반응_구해요: [구해요] 태그, 구해요, 구합니다, 구해용, 구입하실분, 판매처 문의
- 반응_문의: 직접 답변이나 조언을 요청하는 질문형 제목. 궁금, 질문, 어디서 사나요, ~인가요?, 있을까요?, 계신가요?
- 반응_정보: 가격, 성분, 할인, 세일, 무배, 핫딜, 리셀, 발매, 신상, 구매 정보나 경험 정보를 공유하는 제목
- 반응_거래: 완료된 거래, 판매 완료, 예약 완료처럼 거래 상태가 끝난 제목
- 반응_마감문의: 제품 마감이나 품질 상태를 질문하는 제목
- 반응_단순반응: 짧은 감상, 리액션, 단순 소감
- 반응_제품칭찬: 제품의 품질/디자인/만족감을 긍정적으로 말하지만 직접 구매 권유는 아닌 경우
- 반응_제품비판: 제품의 품질/마감/불편/실망을 부정적으로 말하지만 직접 구매 비권유는 아닌 경우
- 반응_일반감상: 상품명 언급, 잡담, 단문 감상, 맥락이 약한 반응
- 반응_구매추천: 구매/착용/사용을 권하는 추천, 추천 요청에 대한 긍정 추천 맥락
- 반응_구매비추천: 사지 말라, 비추천, 후회, 피하라는 구매 비권유 맥락

few-shot 예시:
입력: "궁금합니다" -> 출력: 반응_문의
입력: "어디서 사나요" -> 출력: 반응_문의
입력: "이거 옷 품번 아시나요?" -> 출력: 반응_문의
입력: "구매처 아시는분" -> 출력: 반응_문의
입력: "(완료)베베드피노 몬치치 오버롤 90사이즈" -> 출력: 반응_거래
입력: "베베드피노 원래 마감이 좀 깔끔치 못한가요?" -> 출력: 반응_마감문의
입력: "가방 왜 가벼워야 하는지 이제 알겠네요..ㅠ" -> 출력: 반응_단순반응
입력: "판매처 아시는분" -> 출력: 반응_구해요
입력: "푸마 에이치스트릿 품절풀렸어요" -> 출력: 반응_정보
입력: "푸마 에이치스트릿 에비씨마트 입고요" -> 출력: 반응_정보
입력: "불량 수선받으신 맘님 계신가요" -> 출력: 반응_문의
입력: "[교환] 교환해주세요" -> 출력: 반응_교환
입력: "스피드캣 교환원해요" -> 출력: 반응_교환
입력: "[교환] 블랙150(저) > 140(맘님)" -> 출력: 반응_교환
입력: "구합니다" -> 출력: 반응_구해요
입력: "구해요" -> 출력: 반응_구해요
입력: "[구해요] 실버 130 구해용" -> 출력: 반응_구해요
입력: "구입하실분들" -> 출력: 반응_구해요
입력: "가격이 얼마인가요" -> 출력: 반응_정보
입력: "성분 정보" -> 출력: 반응_정보
입력: "무신사 79000원 무배" -> 출력: 반응_정보
입력: "크림 리셀가 공유" -> 출력: 반응_정보
입력: "최대 80% 할인 핫딜" -> 출력: 반응_정보
입력: "신상 발매 정보" -> 출력: 반응_정보
입력: "왕비추천" -> 출력: 반응_구매추천
입력: "이건 진짜 비추천" -> 출력: 반응_구매비추천
입력: "베베드피노 원래 마감이 좀 깔끔치 못한가요?" -> 출력: 반응_마감문의
입력: "가방 왜 가벼워야 하는지 이제 알겠네요..ㅠ" -> 출력: 반응_단순반응
입력: "베베드피노 몬치치가방" -> 출력: 반응_일반감상

중요: [교환] 또는 [구해요] 태그가 있으면 해당 카테고리로 분류하세요.
중요: 가격/세일/무배/리셀/핫딜/발매/신상처럼 정보를 공유하는 제목은 질문형 어미가 섞여도 반응_정보를 우선 검토하세요.
중요: 구매를 권하면 반응_구매추천, 사지 말라고 하면 반응_구매비추천을 우선하세요.
중요: 질문형 제목은 감상보다 반응_문의를 우선 검토하세요.
중요: 긍정 평가지만 직접 권유는 없으면 반응_제품칭찬, 부정 평가지만 직접 비권유는 없으면 반응_제품비판입니다.
중요: 정말 애매하거나 맥락이 약한 단문만 반응_일반감상으로 분류하세요.
반드시 카테고리 텍스트 하나만 출력하세요.
분류 대상 제목: """

BODY_PROMPT = f"""\
당신은 VOC 본문을 아래 카테고리 중 하나로만 분류하는 분류기입니다.
카테고리 목록:
{LABEL_LINES}

카테고리 기준:
- 반응_교환: 교환 요청, 사이즈 교환, 맞교환
- 반응_구해요: 구매 희망, 구합니다, 구해요, 판매처 수배
- 반응_문의: 직접 답변이나 조언을 구하는 질문
- 반응_정보: 가격, 할인, 무배, 리셀, 발매, 신상, 경험/상황 공유
- 반응_거래: 거래 완료, 판매 완료, 거래 성사
- 반응_마감문의: 제품 마감/품질 상태를 묻는 질문
- 반응_단순반응: 짧은 소감, 리액션, 감상
- 반응_제품칭찬: 만족, 칭찬, 품질/디자인 장점
- 반응_제품비판: 실망, 마감 문제, 불편, 품질 단점
- 반응_일반감상: 감상, 잡담, 맥락 부족
- 반응_구매추천: 사도 된다, 추천한다, 추천템, 잘 샀다
- 반응_구매비추천: 비추천, 사지 마라, 후회, 돈 아깝다
중요: 구매 권유는 반응_구매추천, 구매 비권유는 반응_구매비추천을 우선하세요.
중요: 긍정 평가는 반응_제품칭찬, 부정 평가는 반응_제품비판으로 분류하세요.
중요: 정말 애매하거나 맥락이 약할 때만 반응_일반감상으로 분류하세요.
본문에는 공지와 배너가 제거되어 있을 수 있습니다. 실제 게시글 본문 의미만 보고 분류하세요.
반드시 카테고리 텍스트 하나만 출력하세요.
분류 대상 본문: """
